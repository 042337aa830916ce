"""Error rates of transcriptions, by pair, page and corpus."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.functions import text as T


def spread(pairs: DataFrame, times: int = 4) -> DataFrame:
    """pairs dealt one by one to several partitions for each shuffle partition. A distance costs the product of two lengths, so tables of few
    bytes are much work; dealt by size, or merged as small ones, they would be a few tasks."""
    return pairs.repartition(times * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_edits(pairs: DataFrame, truth: str = "truth", found: str = "found") -> DataFrame:
    """pairs with edits and lengths of characters and words. Null texts are empty."""
    pairs = spread(pairs)
    a, b = (F.coalesce(F.col(c), F.lit("")) for c in (truth, found))
    return pairs.withColumns(
        {
            "char_edits": T.character_distance(a, b), "chars": F.length(a), "found_chars": F.length(b),
            "word_edits": T.word_distance(T.words(a), T.words(b)), "words": F.size(T.words(a)), "found_words": F.size(T.words(b)),
        }
    )


def rates(edited: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Micro rates over the pairs of each group: edits over the truth's length, and accuracies (1 - rate)."""
    total = lambda c: F.sum(F.col(c).cast("long"))
    rate = lambda kind: F.try_divide(total(f"{kind}_edits"), total(f"{kind}s"))
    return edited.groupBy(*by).agg(
        rate("char").alias("cer"), rate("word").alias("wer"), (1 - rate("char")).alias("char_accuracy"), (1 - rate("word")).alias("word_accuracy"),
        total("found_chars").alias("total_chars"), total("found_words").alias("total_words"), F.count("*").alias("pairs"),
    )


def page_scores(edited: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, cer, wer, char_count, word_count); counts are the truth's."""
    scores = edited.groupBy(*page).agg(
        F.try_divide(F.sum("char_edits"), F.sum("chars")).alias("cer"), F.try_divide(F.sum("word_edits"), F.sum("words")).alias("wer"),
        F.sum(F.col("chars").cast("long")).alias("char_count"), F.sum(F.col("words").cast("long")).alias("word_count"),
    )
    return scores


def worst(scores: DataFrame, *, name: Column | str = "page", n: int = 5) -> DataFrame:
    """A row (rank, file, cer) for ranks 1 to n: the pages of the largest rate, by name where equal; null where there are none."""
    name = F.col(name) if isinstance(name, str) else name
    top = scores.select(name.alias("file"), "cer").orderBy(F.desc_nulls_last("cer"), "file").limit(n)
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("cer"), "file")).cast("long"))  # n rows
    return scores.sparkSession.range(1, n + 1).toDF("rank").join(top, "rank", "left")


def matched_lines(truth: DataFrame, found: DataFrame, key: Sequence[str], *, normalise: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """One row (cer, wer, matched_lines), or one for each value of by (columns of key), over lines that both sides have, as decomposed
    code points. No lines: null rates, or no row."""
    pairs = truth.select(*key, F.col("text").alias("truth")).join(found.select(*key, F.col("text").alias("found")), list(key))
    if normalise:
        pairs = pairs.withColumn("truth", T.nfd(F.col("truth"))).withColumn("found", T.nfd(F.col("found")))
    return rates(with_edits(pairs), by).select(*by, "cer", "wer", F.col("pairs").alias("matched_lines"))


def _rows(first: np.ndarray, own: np.ndarray, b: np.ndarray):
    """Rows of the distance table after first, one for each symbol of own."""
    steps, last = np.arange(len(b) + 1), first
    for x in own:
        row = np.empty_like(last)
        row[0] = last[0] + 1
        row[1:] = np.minimum(last[:-1] + (b != x), last[1:] + 1)
        last = np.minimum.accumulate(row - steps) + steps  # what insertions along the row make of it
        yield last


def alignment(a: Sequence[str], b: Sequence[str]) -> list[tuple[str, str, str]]:
    """(operation, symbol of a, symbol of b) of the differences in a cheapest alignment.

    From the ends, a symbol that is equal is matched first, then substitution, deletion, insertion are tried. Every so many
    rows of the distance table are kept for the way back and those between are made again, so a text of n symbols needs room
    for about 2 * sqrt(n) rows; time is the product of the lengths.
    """
    codes = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    x, y = (np.array([codes[s] for s in t], np.int32) for t in (a, b))
    every = max(1, int(len(a) ** 0.5))
    kept = [np.arange(len(b) + 1, dtype=np.int32)]
    for i, row in enumerate(_rows(kept[0], x, y), 1):
        if i % every == 0:
            kept.append(row)
    out, i, j = [], len(a), len(b)
    block, rows = None, []
    while i or j:
        k = max(0, i - 1) // every
        if k != block:
            block, rows = k, [kept[k], *_rows(kept[k], x[k * every : (k + 1) * every], y)]
        here = rows[i - k * every]
        above = rows[i - k * every - 1] if i else None
        if i and j and x[i - 1] == y[j - 1] and here[j] == above[j - 1]:
            i, j = i - 1, j - 1
        elif i and j and here[j] == above[j - 1] + 1:
            i, j = i - 1, j - 1
            out.append(("substitution", a[i], b[j]))
        elif i and here[j] == above[j] + 1:
            i -= 1
            out.append(("deletion", a[i], ""))
        else:
            j -= 1
            out.append(("insertion", "", b[j]))
    return out[::-1]


def pieces(batches, most_bytes: int = 1 << 20):
    """Arrow batches cut so that the words of many pairs never stand in memory as objects at once: of a pair of average size, some hundred."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def operations(pairs: DataFrame, *, level: str = "word", truth: str = "truth", found: str = "found", by: str | None = None) -> DataFrame:
    """(operation, truth, found, n) over all pairs, of words or of user-perceived characters of decomposed texts. by: a column of text, whose
    values are counted apart.

    Only the number of all operations of a pair is canonical; which symbols they name depends on how ties are taken. Null
    texts are empty. Time grows with the product of a pair's lengths, room with the longer text (see alignment()), not with the pairs of a
    task.
    """
    if level == "word":
        split = T.words
    else:
        split = lambda c: T.graphemes(T.nfd(F.coalesce(c, F.lit(""))))
    # equal texts have no operations and do not go to Python
    own = F.col(by) if by else F.lit(None).cast("string")
    rows = pairs.filter(~F.col(truth).eqNullSafe(F.col(found))).select(split(F.col(truth)).alias("a"), split(F.col(found)).alias("b"), own.alias("by"))

    def run(batches):
        for batch in pieces(batches):
            counts: dict[tuple[str, str, str, str], int] = {}
            for a, b, key in zip(*(batch[c].to_pylist() for c in ("a", "b", "by")), strict=True):
                for x in alignment(a, b):
                    counts[key, *x] = counts.get((key, *x), 0) + 1
            columns = [*zip(*counts), counts.values()] if counts else [[]] * 5
            kinds = [pa.string()] * 4 + [pa.int64()]
            arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["by", "operation", "truth", "found", "n"])

    made = rows.mapInArrow(run, "by string, operation string, truth string, found string, n long")
    made = made.withColumnRenamed("by", by) if by else made.drop("by")
    return made.groupBy(*([by] if by else []), "operation", "truth", "found").agg(F.sum("n").alias("n"))


def pairing_modes(truth_lines: DataFrame, found_lines: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, mode, idx, truth, found): the texts of a page that are compared.

    Lines have page columns, idx, text. One found line against more than one true line: it is split at line breaks; as
    many parts as true lines are compared "line" by line, others as "joined" texts. All else: "whole" texts in the
    order of the document. Pairs with a blank truth are dropped.
    """
    of = lambda lines, name: lines.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("idx", F.coalesce("text", F.lit("")).alias("text")))).alias(name))
    pages = of(truth_lines, "t").join(of(found_lines, "f"), list(page))
    texts = lambda c: F.transform(c, lambda x: x["text"])
    parts = T.lines(texts("f")[0])
    single = (F.size("f") == 1) & (F.size("t") > 1)
    mode = F.when(single & (F.size(parts) == F.size("t")), "line").when(single, "joined").otherwise("whole")
    pages = pages.select(*page, mode.alias("mode"), texts("t").alias("t"), texts("f").alias("f"), parts.alias("parts"))
    filled = lambda x: F.filter(x, lambda s: T.stripped(s) != "")
    joined = lambda x: F.array_join(filled(x), " ")
    pair = lambda a, b, i: F.struct(i.cast("int").alias("idx"), a.alias("truth"), b.alias("found"))
    by_line = F.transform("t", lambda x, i: pair(x, F.get("parts", i), i))
    rows = (
        F.when(F.col("mode") == "line", by_line)
        .when(F.col("mode") == "joined", F.array(pair(joined(F.col("t")), F.array_join("parts", " "), F.lit(0))))
        .otherwise(F.array(pair(joined(F.col("t")), joined(F.col("f")), F.lit(0))))
    )
    rows = pages.select(*page, "mode", F.explode(rows).alias("p")).select(*page, "mode", "p.*")
    return rows.filter(T.stripped(F.col("truth")) != "")


def word_overlap(pairs: DataFrame, key: Sequence[str], truth: str = "truth", found: str = "found") -> DataFrame:
    """(key columns, common): words of both texts, each as often as both have it."""
    bag = lambda side, name: (
        pairs.select(*key, F.explode(T.words(F.col(side))).alias("word")).groupBy(*key, "word").agg(F.count("*").alias(name))
    )
    both = bag(truth, "n_a").join(bag(found, "n_b"), [*key, "word"])
    common = both.groupBy(*key).agg(F.sum(F.least("n_a", "n_b")).alias("common"))
    return pairs.select(*key).distinct().join(common, list(key), "left").fillna(0, ["common"])
