"""License scans: k-gram matches vote for diagonals of a template; merged diagonals are verified."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common
from foliomill.sinks.paths import shuffled

#: Base phrases (words) and their labels: fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Licenses by label, with the names they go by.
NAMES = {
    "mit": ("MIT License",),
    "apache-2": ("Apache License, Version 2.0",),
    "apache-1.1": ("Apache Software License, Version 1.1",),
    "bsd-2": ("BSD 2-Clause License", "Simplified BSD License"),
    "bsd-3": ("BSD 3-Clause License", "New BSD License"),
    "bsd-4": ("BSD 4-Clause License", "Original BSD License"),
    "isc": ("ISC License",),
    "bsl-1": ("Boost Software License, Version 1.0",),
    "gpl-2": ("GNU General Public License, version 2",),
    "gpl-3": ("GNU General Public License, version 3",),
    "lgpl-2.1": ("GNU Lesser General Public License, version 2.1",),
    "lgpl-3": ("GNU Lesser General Public License, version 3",),
    "agpl-3": ("GNU Affero General Public License, version 3",),
    "gfdl-1.3": ("GNU Free Documentation License, Version 1.3",),
    "mpl-1.1": ("Mozilla Public License, version 1.1",),
    "mpl-2": ("Mozilla Public License, version 2.0",),
    "epl-1": ("Eclipse Public License, version 1.0",),
    "epl-2": ("Eclipse Public License, version 2.0",),
    "cddl-1": ("Common Development and Distribution License, Version 1.0",),
    "cpl-1": ("Common Public License, version 1.0",),
    "eupl-1.2": ("European Union Public Licence, version 1.2",),
    "artistic-2": ("Artistic License, version 2.0",),
    "afl-3": ("Academic Free License, version 3.0",),
    "osl-3": ("Open Software License, version 3.0",),
    "ofl-1.1": ("SIL Open Font License, Version 1.1",),
    "odbl-1": ("Open Data Commons Open Database License, version 1.0",),
    "ms-pl": ("Microsoft Public License",),
    "ms-rl": ("Microsoft Reciprocal License",),
    "php-3": ("PHP License, version 3.01",),
    "python-2": ("Python Software Foundation License, version 2",),
    "lppl-1.3": ("LaTeX Project Public License, version 1.3",),
    "ecl-2": ("Educational Community License, Version 2.0",),
    "ncsa": ("University of Illinois NCSA Open Source License",),
    "postgresql": ("PostgreSQL License",),
    "cc0": ("Creative Commons CC0 1.0 Universal Public Domain Dedication",),
}
#: Words of Creative Commons licenses, by the letters in their labels.
COMMONS = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
FORMS = ("Licensed under the {}", "Released under the {}", "This work is licensed under the {}")

#: Texts and notices that are not made of a name and a form, by label.
TEXTS = (
    ("mit", "This project is licensed under the terms of the MIT license"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
     associated documentation files (the "Software"), to deal in the Software without restriction, including
     without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
     copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
     following conditions: The above copyright notice and this permission notice shall be included in all
     copies or substantial portions of the Software."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
     hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
     software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
     OF ANY KIND, either express or implied."""),
    *((f"{gnu}-{version}", f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU
     {name} Public License as published by the Free Software Foundation, either version {version} of the License, or (at
     your option) any later version.""") for gnu, name, versions in (
         ("gpl", "General", ("2", "3")), ("lgpl", "Lesser General", ("2.1", "3")), ("agpl", "Affero General", ("3",))) for version in versions),
    *((f"bsd-{n}", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
     "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
     "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
     + more + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
     "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.") for n, more in (
         (2, ""), (3, "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                      "software without specific prior written permission. "))),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
     was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def commons(letters: str) -> list[str]:
    """Notices of a Creative Commons license: of its letters, and of its words in full."""
    words_ = "-".join(COMMONS[x] for x in letters.split("-"))
    return [
        f"Licensed under CC {letters.upper()} 4.0", f"This work is licensed under CC {letters.upper()} 4.0",
        f"Licensed under a Creative Commons {words_} 4.0 International License", f"This work is licensed under a Creative Commons {words_} 4.0 International License",
    ]


#: Notices and license texts by label; a label has several. Any other list of (label, text) can be given to scan().
TEMPLATES = (
    *((label, form.format(name)) for label, names in NAMES.items() for name in names for form in FORMS), *TEXTS,
    *((f"cc-{x}", text) for x in ("by", "by-nc", "by-nd", "by-sa", "by-nc-nd", "by-nc-sa") for text in commons(x)),
)

#: Words that make another license of one: where they stand within a template's span, or just behind it, that is not the one meant.
OTHERS = {
    "cc": ({"nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike"}, 3),
    "gpl": ({"lesser", "library", "affero"}, 0), "lgpl": ({"affero"}, 0), "agpl": ({"lesser", "library"}, 0),
}
#: Words that take a notice back, where they stand up to so many words before it, or within it and not in the template.
DENIED, BEFORE = {"not", "no", "never", "neither", "nor", "cannot", "isn", "wasn", "aren"}, 3


def keys(label: str) -> set[bytes]:
    """Words that a template of a label may not lose, if it has them: those of the label (mit; apache and 2), words in full too."""
    own = [w for part in label.split("-") for w in part.split(".")]
    names = {w for name in NAMES.get(label, ()) for w in name.replace(",", " ").replace("-", " ").split()} - GENERAL
    return {w.lower().encode() for w in (*own, *(COMMONS[w] for w in own if w in COMMONS), *names)}


#: Words in names that do not tell licenses apart, and numbers that go without saying.
GENERAL = {"License", "Licence", "Public", "Software", "Source", "General", "Version", "version", "and", "of", "Project", "0", "2.0", "1.0", "3.0", "3.01", "2.1", "1.1", "1.2", "1.3", "Creative", "Commons", "Union", "Foundation", "Universal", "Domain", "Dedication", "University"}

#: Bytes of words stay (A-Z as a-z), all others become a space: words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


#: Bytes of texts whose words stand in memory at once: as objects, with hashes, they take several times as much.
AT_ONCE = 1 << 20


def words(text: str | None) -> list[bytes]:
    """Words of a whole text; null gives none."""
    return text.encode().translate(_WORDS).split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling_hashes(own: list[bytes], k: int, at_once: int = 100_000) -> np.ndarray:
    """A 64-bit hash for each run of k words, in order; a long text is hashed piece by piece."""
    n = len(own) - k + 1
    pieces = [_hashes(own[i : i + at_once + k - 1], k) for i in range(0, n, at_once)]
    return np.concatenate(pieces) if pieces else np.zeros(0, np.int64)


def _hashes(own: list[bytes], k: int) -> np.ndarray:
    data = np.frombuffer(b" ".join(own), np.uint8)
    gaps = np.flatnonzero(data == 0x20)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    with np.errstate(over="ignore"):
        powers, inverses = _powers(len(data) + 1)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * powers[: len(data)], out=prefix[1:])
        word = _mixed((prefix[ends] - prefix[starts]) * inverses[starts])  # its polynomial, wherever it stands
        out = np.zeros(len(word) - k + 1, np.uint64)
        for i in range(k):
            out = out * _BASE + word[i : len(word) - k + 1 + i]
        return _mixed(out).view(np.int64)


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_table: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse, kept by the worker."""
    if not _table or len(_table[0]) < n:
        size = max(n, 1 << 17)
        with np.errstate(over="ignore"):
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            _table[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _table[0], _table[1]


def changes(n: int, least: float) -> int:
    """How many words of a template of n words can be changed, put in or left out at a similarity of least."""
    return int(n * (1 - least) + 1e-9)


def gram_size(n: int, least: float, k: int) -> int:
    """The most words up to k of grams of which one at least is left, whatever the changes; 1 at least."""
    return max((g for g in range(1, k + 1) if n - g + 1 - g * changes(n, least) >= 1), default=1)


def votes_needed(n: int, least: float, k: int) -> int:
    """A change takes away gram_size grams of a template at most: so many are left."""
    g = gram_size(n, least, k)
    return max(1, n - g + 1 - g * changes(n, least))


def template_positions(spark, templates, k: int, least: float) -> DataFrame:
    """(hash, template, at) of every gram of the templates: a table as small as their texts."""
    rows = []
    for t, (_, text) in enumerate(templates):
        own = words(text)
        rows += [(int(h), t, at) for at, h in enumerate(rolling_hashes(own, gram_size(len(own), least, k)))] if own else []
    return spark.createDataFrame(rows, "hash long, template int, at int")


def _keys(text: Column) -> dict[str, Column]:
    """128 bits of a text: equal texts have the same spans, so they are looked for once."""
    return {"_text_a": F.xxhash64(F.lit(1), text), "_text_b": F.xxhash64(F.lit(2), text)}


def candidate_spans(docs: DataFrame, templates, *, k: int = 3, least: float = 0.8, shift: int = 4, text_col: str = "text") -> DataFrame:
    """Where diagonals vote for a template: (_text_a, _text_b, spans: array of template, low, high), a written table.

    All rolling hashes of grams of all texts are joined with the template positions: grams of k words, of fewer for templates
    so short that changes could leave no gram whole. Matches are counted for each diagonal (place in the text minus place in
    the template); diagonals at most shift apart, or as far as the changes that the template allows can move it, are merged.
    A merged group is a candidate if it has as many votes as any span that is least similar has. low and high are its first
    and last diagonal: a template without changes would begin there.
    """
    sizes = [len(words(text)) for _, text in templates]
    grams_used = sorted({gram_size(n, least, k) for n in sizes if n})

    def run(batches):
        for batch in common.small_batches(batches, AT_ONCE):
            own = [words(t) for t in batch.column(2).to_pylist()]
            for g in grams_used:
                hashes = [rolling_hashes(w, g) for w in own]
                ends = np.cumsum([0, *map(len, hashes)])
                flat = pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64))
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), flat).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["_text_a", "_text_b", "hashes"])

    keys = _keys(F.col(text_col))
    texts = docs.filter(F.col(text_col) != "").select(*[v.alias(n) for n, v in keys.items()], F.col(text_col).alias("text"))
    grams = texts.mapInArrow(run, "_text_a long, _text_b long, hashes array<long>")
    grams = grams.select(*keys, F.posexplode("hashes").alias("place", "hash"))
    spark = docs.sparkSession
    positions = template_positions(spark, templates, k, least)
    bounds = [(t, votes_needed(n, least, k), max(shift, changes(n, least))) for t, n in enumerate(sizes)]
    bounds = spark.createDataFrame(bounds, "template int, needed int, reach int")
    small = len(templates) * max([1, *sizes]) <= 1_000_000  # the templates' words, not the corpus's; larger lists are shuffled
    hinted = F.broadcast if small else (lambda x: x)
    found = grams.join(hinted(positions), "hash")
    by = [*keys, "template"]
    found = found.select(*by, (F.col("place") - F.col("at")).alias("diagonal"), "at").distinct()  # copies meet here
    votes = found.groupBy(*by, "diagonal").agg(F.count("*").alias("votes")).join(hinted(bounds), "template")
    along = Window.partitionBy(*by).orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("reach")
    votes = votes.withColumn("group", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(along))
    merged = votes.groupBy(*by, "group").agg(
        F.sum("votes").alias("votes"), F.first("needed").alias("needed"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high")
    )
    merged = merged.filter("votes >= needed")
    spans = merged.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("template", "low", "high"))).alias("spans"))
    return common.written(spans, "license-candidates")


def nearest_span(text_words: list[bytes], want: list[bytes]) -> tuple[int, int, int]:
    """(edits, first, last) of the run of words that is nearest to want, by words changed, put in and left out.

    The first such run to end, and of those that end there the shortest. A row of the alignment is kept for each word.
    """
    codes = {w: i for i, w in enumerate(dict.fromkeys(want))}
    wanted = np.array([codes[w] for w in want])
    edit, steps = 1 << 32, np.arange(len(want) + 1, dtype=np.int64) << 32
    row = steps.copy()  # edits << 32, less the place where the run begins
    best = (int(row[-1]) + edit, 0)
    for j, w in enumerate(text_words):
        code = codes.get(w, -1)
        new = np.empty_like(row)
        new[0] = -(j + 1)
        new[1:] = np.minimum(row[:-1] + np.where(wanted == code, 0, edit), row[1:] + edit)
        row = np.minimum.accumulate(new - steps) + steps
        if -(-int(row[-1]) >> 32) < -(-best[0] >> 32):
            best = (int(row[-1]), j)
    edits = -(-best[0] >> 32)
    return edits, (edits << 32) - best[0], best[1]


def denied(text_words: list, first: int, last: int, want: list) -> bool:
    """Whether words first to last, or those just before, say that the license is not meant."""
    inside = [w for w in text_words[first : last + 1] if w.decode() in DENIED]
    return any(w.decode() in DENIED for w in text_words[max(0, first - BEFORE) : first]) or len(inside) > sum(w.decode() in DENIED for w in want)


def meant(text_words: list, first: int, last: int, want: list, label: str) -> bool:
    """Whether words first to last can be the license of that label, and are not another of its family."""
    own = set(text_words[first : last + 1])
    if not keys(label) & set(want) <= own:
        return False
    others, behind = OTHERS.get(label.split("-")[0], (set(), 0))
    around = own | set(text_words[last + 1 : last + 1 + behind])
    return not ({w.encode() for w in others} - set(want)) & around and not denied(text_words, first, last, want)


def verified(text_words: list, spans, templates: list[list], names: list[str], least: float) -> list[tuple[int, int, int, float]]:
    """(template, first, last, similarity) of candidates where some run of words is least similar to the template.

    similarity: 1 less the share of the template's words that have to be changed, put in or left out. Words that tell
    licenses apart have to be as they are (see meant()): else it is another license, or none.
    """
    out, needed = [], {}
    for template, low, high in spans:
        want = templates[template]
        if template not in needed:
            needed[template] = keys(names[template]) & set(want)
        e = changes(len(want), least)
        start = max(0, low - e)
        own = text_words[start : high + len(want) + e]
        if not needed[template] <= set(own):
            continue
        edits, first, last = nearest_span(own, want)
        if edits <= e and meant(text_words, start + first, start + last, want, names[template]):
            out.append((template, start + first, start + last, 1 - edits / len(want)))
    return out


def undisputed(found: list[tuple[int, int, int, float]], labels: list[str]) -> list[tuple[int, int, int, float]]:
    """Spans without those that share words with a more similar (then longer, then earlier template's) span of another label.

    Licenses of a family differ in a word or two, so the text of one is also near to the others' templates.
    """
    kept: list[tuple[int, int, int, float]] = []
    for x in sorted(set(found), key=lambda x: (-x[3], x[1] - x[2], x[0], x[1])):
        if all(labels[x[0]] == labels[y[0]] or x[2] < y[1] or y[2] < x[1] for y in kept):
            kept.append(x)
    return sorted(kept)


def base_places(joined: bytes, phrases: Mapping[bytes, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after the other."""
    out, padded = [], b" " + joined + b" "
    for phrase, label in phrases.items():
        want, at, seen, words_before = b" " + phrase + b" ", -1, 0, 0
        while (at := padded.find(want, at + 1)) >= 0:
            words_before += padded.count(b" ", seen, at)
            seen = at
            out.append((words_before, label))
    return sorted(out)


#: Bits of marks(): a megabyte, whatever the corpus. A million candidates set an eighth of them.
MARKS = 1 << 23


def _block() -> Column:
    return F.shiftright(F.pmod("_text_a", F.lit(MARKS)), 6)


def _bit() -> Column:
    return F.expr("shiftleft(1L, cast(_text_a & 63 as int))")


def marks(candidates: DataFrame) -> DataFrame:
    """(_block, _bits): a bit for each hash of a text with candidates, MARKS / 64 rows at most. A text whose bit is not set has none."""
    return candidates.groupBy(_block().alias("_block")).agg(F.bit_or(_bit()).alias("_bits"))


def scan(
    docs: DataFrame, *, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES, least: float = 0.8, k: int = 3, shift: int = 4,
    most_small: int = 100_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row for each document: doc_id, n_words, places (first word and label of each base phrase), spans
    (label, first, last, similarity: verified and undisputed), labels (sorted, distinct, of both), score.

    A span is found wherever a run of words takes least changes (least of its words, at 0.8 a fifth) to become a template;
    it is the nearest run around its diagonals, and holds the words that tell licenses apart. score is 1 where a base phrase
    stands and words before it do not deny it (0.5 where they do), else the largest similarity of a span, else 0. Ties: of runs as near the first and shortest; of spans of two labels on the same words the longer, then
    the earlier template's. Null and empty texts have no words and no labels. Very long texts are hashed piece by piece,
    whole. Repeated rows each give a row; null ids are kept. An empty table gives no rows. Columns other than the two are
    not read.

    Texts stay where they are while candidates have most_small spans or fewer in all, which then are broadcast. Beyond, a bitmap of fixed
    size (see marks()) tells texts that can have candidates, few of all; these alone meet candidates by a 128-bit hash, dealt to 16 salts, so that
    copies of one text do not gather. That join is always a shuffled one: Spark takes the size of candidates from their compressed files, before
    each is dealt to all salts.
    """
    names, wanted = [label for label, _ in templates], [words(t) for _, t in templates]
    base = {b" ".join(words(p)): label for p, label in phrases.items()}
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("similarity", pa.float64())])

    def run(batches):
        for batch in common.small_batches(batches, AT_ONCE):
            n_words, places, spans, labels, scores = [], [], [], [], []
            for text, candidates in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = words(text)
                hits = base_places(b" ".join(own), base) if own else []
                good = verified(own, [(c["template"], c["low"], c["high"]) for c in candidates or ()], wanted, names, least)
                good = undisputed(good, names)
                n_words.append(len(own))
                places.append([{"word": at, "label": label} for at, label in hits])
                spans.append([{"label": names[t], "first": a, "last": b, "similarity": s} for t, a, b, s in good])
                labels.append(sorted({label for _, label in hits} | {names[t] for t, *_ in good}))
                sure = any(not any(w.decode() in DENIED for w in own[max(0, at - BEFORE) : at]) for at, _ in hits)
                scores.append(1.0 if sure else max([0.5 if hits else 0.0, *(s for *_, s in good)]))
            kinds = (pa.int64(), pa.list_(place), pa.list_(span), pa.list_(pa.string()), pa.float64())
            arrays = [pa.array(x, t) for x, t in zip((n_words, places, spans, labels, scores), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_words", "places", "spans", "labels", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    candidates = candidate_spans(rows, templates, k=k, least=least, shift=shift)
    on = ["_text_a", "_text_b"]
    if (candidates.agg(F.sum(F.size("spans"))).first()[0] or 0) <= most_small:
        rows = rows.withColumns(_keys(F.col("text"))).join(F.broadcast(candidates), on, "left").select("doc_id", "text", "spans")
    else:
        salt = F.pmod("_place", F.lit(16)).alias("_salt")
        rows = common.placed(docs, "_place").select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), salt)
        rows = rows.withColumns(_keys(F.col("text"))).withColumn("_block", _block()).join(F.broadcast(marks(candidates)), "_block", "left")
        can = F.coalesce(F.col("_bits").bitwiseAND(_bit()) != 0, F.lit(False))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long")))
        met = rows.filter(can).join(shuffled(candidates.withColumn("_salt", every)), [*on, "_salt"], "left")
        none = rows.filter(~can).withColumn("spans", F.lit(None).cast(candidates.schema["spans"].dataType))
        rows = met.select("doc_id", "text", "spans").unionByName(none.select("doc_id", "text", "spans"))
    kinds = (
        "doc_id long, n_words long, places array<struct<word: long, label: string>>, "
        "spans array<struct<label: string, first: long, last: long, similarity: double>>, labels array<string>, score double"
    )
    return rows.mapInArrow(run, kinds)
