"""Text functions as Column builders. Those that need Python say so."""

from __future__ import annotations

import unicodedata
from textwrap import TextWrapper

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from foliomill.functions import charsets

#: Unicode white space; Spark's trim() knows spaces only.
SPACE = r"(?U)\s"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank(text: Column) -> Column:
    return text.isNull() | (stripped(text) == "")


def words(text: Column) -> Column:
    """Words between white space; null and blank texts have none."""
    own = stripped(F.coalesce(text, F.lit("")))
    return F.when(own == "", F.array().cast("array<string>")).otherwise(F.split(own, r"(?U)\s+"))


def lines(text: Column) -> Column:
    """Lines without blank ones, stripped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), stripped), lambda x: x != "")


def split_lines(text: Column) -> Column:
    """At any line break; a break at the end adds no line."""
    return F.split(F.regexp_replace(text, r"\R$", ""), r"\R")


def _class(characters) -> str:
    """A regular-expression class of the characters, none of which has a meaning there."""
    return "".join(f"\\x{{{ord(c):X}}}" for c in dict.fromkeys("".join(characters)))


def whitelist() -> str:
    """The class of allowed characters: the special sets, Latin letters, numbers, marks and punctuation, white space."""
    special = _class([*charsets.COMBINING, *charsets.MEDIEVAL, *charsets.SUPERSCRIPT])
    latin = r"[\x{20}-\x{24F}&&[\p{L}\p{N}\p{P}\p{Z}\p{M}]]"
    additional = r"[\x{1E00}-\x{1EFF}&&[\p{L}\p{M}]]"
    return rf"[{special}{latin}{additional}\x20\t\n\r]"


def only_allowed(text: Column) -> Column:
    """Without characters off the whitelist. ASCII, most of all texts, is told by a small class of what is not allowed there; the large
    class is tried on other characters only."""
    kept = lambda c: unicodedata.category(c)[0] in "LNPZ" or c in "\t\n\r" or c in "".join([*charsets.COMBINING, *charsets.MEDIEVAL, *charsets.SUPERSCRIPT])
    ascii_ = _class(c for c in map(chr, range(0x80)) if not kept(c))
    return F.regexp_replace(text, rf"[{ascii_}]|(?=[^\x00-\x7F])[^{whitelist()[1:-1]}]", "")


def normalised(text: Column, extended: bool = False) -> Column:
    """Replaces allographs. No target is itself replaced, so all go at once."""
    norms = charsets.BASE_NORMS | (charsets.EXTENDED_NORMS if extended else {})
    one = {a: b for a, b in norms.items() if b}
    gone = [a for a, b in norms.items() if not b]
    return F.translate(text, "".join([*one, *gone]), "".join(one.values()))


# What is taken out of a transcription, in this order: lacunae, tags, brackets around text.
MARKUP = ((r"\[\.{2,}\]|\[…\]", ""), (r"<[^>]*>", ""), (r"\[([^\]]*)\]", "$1"))


def without_markup(text: Column) -> Column:
    for pattern, by in MARKUP:
        text = F.regexp_replace(text, pattern, by)
    return text


def cleaned(text: Column, extended: bool = False) -> Column:
    """A transcription without lacunae, tags and brackets, with normalised and allowed characters only."""
    return only_allowed(normalised(without_markup(text), extended))


def density(text: Column, characters) -> Column:
    """Share of the text's characters that are in the set; 0.0 for empty and null texts."""
    rest = F.length(F.regexp_replace(text, f"[{_class(characters)}]", ""))
    return F.coalesce(F.try_divide(F.length(text) - rest, F.length(text)), F.lit(0.0))


def graphemes(text: Column) -> Column:
    """User-perceived characters of an NFD text."""
    return F.regexp_extract_all(text, F.lit(r"\X"), F.lit(0))


def nfd(text: Column) -> Column:
    """Canonical decomposition; ASCII texts stay in the JVM, others need Python."""

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else unicodedata.normalize("NFD", t))

    return F.when(F.length(text) == F.octet_length(text), text).otherwise(run(text))


def wrapped(text: Column, width: int = 1024) -> Column:
    """Pieces of at most width characters, cut at white space only; longer words stay whole. Needs Python."""

    @F.pandas_udf("array<string>")
    def run(x: pd.Series) -> pd.Series:
        w = TextWrapper(width, break_long_words=False, break_on_hyphens=False, replace_whitespace=False)
        return x.map(lambda t: w.wrap(t) if t else [])

    return run(text)


def word_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of words: each distinct word becomes a character, then levenshtein().

    Characters start at U+4E00, skip the surrogates and go on beyond U+FFFF, so a pair may hold a million distinct words;
    more raise an error.
    """
    both = F.array_distinct(F.concat(a, b))
    codes = F.map_from_arrays(both, F.transform(F.sequence(F.lit(1), F.greatest(F.size(both), F.lit(1))), _character))
    word = lambda x: lambda m: F.array_join(F.transform(x, lambda w: m[w]), "")
    # the outer lambda binds the map, so it is made once for a pair and not for each word
    both_codes = F.transform(F.array(codes), lambda m: F.levenshtein(word(a)(m), word(b)(m)))
    return F.when(F.size(both) == 0, F.lit(0)).otherwise(F.get(both_codes, 0))


def _character(i: Column) -> Column:
    point = F.lit(0x4E00) + i + F.when(i + 0x4E00 >= 0xD800, F.lit(0x800)).otherwise(F.lit(0))
    above = point - 0x10000
    pair = F.concat(F.hex(F.lit(0xD800) + F.shiftright(above, 10)), F.hex(F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))))
    units = F.when(point <= 0xFFFF, F.hex(point)).when(point <= 0x10FFFF, pair).otherwise(F.raise_error(F.lit("too many distinct words in a pair")))
    return F.decode(F.unhex(units), "UTF-16BE")


def character_distance(a: Column, b: Column) -> Column:
    return F.when(a == b, F.lit(0)).otherwise(F.levenshtein(a, b))


def file_name(text: Column) -> Column:
    """Letters, digits, hyphen and underscore; all others, spaces too, become underscores."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_")


def metric_name(text: Column) -> Column:
    return F.translate(text, " /-", "___")


def display_name(document: Column, page: Column) -> Column:
    """document/page, or the page alone where there is no document."""
    return F.concat_ws("/", F.nullif(document, F.lit("")), page)


def metric_parts(key: Column) -> Column:
    """struct(kind, feature, value, metric) of keys score/avg_<feature>_<metric> and by_<feature>/<value>/<metric>; else null.

    A feature may hold underscores: a metric is what follows the last.
    """
    part = lambda pattern, i: F.nullif(F.regexp_extract(key, pattern, i), F.lit(""))
    average, by = r"^score/avg_(.+)_([^_]+)$", r"^by_([^/]+)/([^/]+)/([^/]+)$"
    of = lambda kind, feature, value, metric: F.struct(F.lit(kind).alias("kind"), feature.alias("feature"), value.alias("value"), metric.alias("metric"))
    none = F.lit(None).cast("string")
    return F.when(key.rlike(average), of("average", part(average, 1), none, part(average, 2))).when(key.rlike(by), of("value", part(by, 1), part(by, 2), part(by, 3)))


def supported(own: Column, known) -> Column:
    """Whether a model's type is one of known, as it is or by model_type() of both; false for null."""
    names = F.array(*[F.lit(k) for k in known])
    both = F.array_contains(names, own) | F.exists(names, lambda k: model_type(k) == model_type(own))
    return F.coalesce(both, F.lit(False))


def model_type(text: Column) -> Column:
    """A model's type for comparison: digit_digit as a version dot, hyphens for underscores, no known ending.

    A digit between two underscores gets one dot only. Empty texts give null.
    """
    dotted = F.regexp_replace(text, r"(\d)_(\d)", "$1.$2")
    return F.nullif(F.regexp_replace(F.translate(dotted, "_", "-"), "-(text|vision|chat|instruct|model)$", ""), F.lit(""))


def prompt_block(conventions: Column) -> Column:
    """The sentences of the known values of a map of conventions, in fixed order, a line each."""
    sentence = lambda key: F.create_map(*[F.lit(x) for kv in CONVENTIONS[key].items() for x in kv])[F.element_at(conventions, key)]
    return F.array_join(F.array_compact(F.array(*[sentence(k) for k in CONVENTIONS])), "\n")


# Conventions of a transcription and the sentence for each value.
CONVENTIONS = {
    "abbreviations": {
        "keep": "Keep abbreviations as written, do not expand them.",
        "resolve": "Resolve and expand all abbreviations.",
    },
    "word_segmentation": {
        "original": "Preserve the original word segmentation.",
        "modern": "Modernize word segmentation (split or join words following modern usage).",
    },
    "uv_ij": {
        "original": "Keep original u/v and i/j distinctions as written.",
        "modern": "Modernize u/v and i/j usage.",
        "ui_only": "Use only u and i, never v and j, regardless of the original or modern usage.",
    },
    "allographs": {
        "true": "Preserve allographic variants (e.g. long s 'ſ', special letter forms).",
        "false": "Do not record allographic variants, use standard letter forms.",
    },
}


def prompt(template: Column, block: Column) -> Column:
    """template with {conventions} replaced; without conventions the place is cut and the rest stripped."""
    return F.when(block == "", stripped(F.replace(template, F.lit("{conventions}"), F.lit("")))).otherwise(
        F.replace(template, F.lit("{conventions}"), block)
    )
