"""SimHash fingerprints, and their links at few differing bits through deletion variants."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm import common
from foliomill.llm.components import connected_components

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash over a whole text's word shingles, repeats included.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than a shingle: all of
    them make one; none (null and empty texts): 0. A bit is 1 if over half of the shingles' XXH64 have it.
    """
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    pairs = zip(starts, ends[shingle_words - 1 :] or ends[-1:])  # noqa: B905  the last starts have no whole shingle
    hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle_words: int = 3) -> Column:
    """fingerprint() of a text column as a signed long of the same bits."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        found = [fingerprint(t, shingle_words) for t in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return run(text)


def _cuts(most_bits: int) -> list[tuple[int, int]]:
    """Segments (first bit, end) of a fingerprint: so many that of two with most_bits differing bits one differs by one at most."""
    n = most_bits // 2 + 1
    width = 64 // n
    return [(i * width, 64 if i == n - 1 else (i + 1) * width) for i in range(n)]


def _bits(x: Column, a: int, b: int) -> Column:
    """Bits a to b, without b, of a long."""
    return x if b - a == 64 else F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << (b - a)) - 1))


def _entries(fp: Column, cuts: list[tuple[int, int]]) -> Column:
    """Index entries of a fingerprint: each segment as it is (slot 65 * segment) and with each of its bits deleted (the
    slots after it)."""

    def entry(slot: Column, key: Column) -> Column:
        return F.struct(slot.cast("int").alias("slot"), key.alias("key"))

    def deleted(k: int, value: Column, width: int) -> Column:
        one = lambda bit: F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        return F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)), lambda bit: entry(65 * k + 1 + bit, value.bitwiseAND(F.bitwise_not(one(bit))))
        )

    parts = []
    for k, (a, b) in enumerate(cuts):
        value = _bits(fp, a, b)
        parts += [F.array(entry(F.lit(65 * k), value)), deleted(k, value, b - a)]
    return F.concat(*parts)


def _meeting(most_bits: int, cuts: list[tuple[int, int]], hot: int | None):
    """A function of batches (slot, fp, block, own, group) sorted by group that gives the near pairs of each group.

    Two entries with a bit deleted meet if they differ in that bit, others in any case; in a group of two blocks those of
    different blocks do. Groups of over hot entries give their entries back instead, as they stream by.
    """
    place = np.full(65 * len(cuts), -1)  # the deleted bit of each slot
    for k, (a, b) in enumerate(cuts):
        place[65 * k + 1 : 65 * k + 1 + b - a] = np.arange(a, b)

    def pairs(x: dict[str, np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x["fp"])
        after = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) - np.arange(n) - 1  # entries of the group
        at = place[x["slot"]]
        side = (x["fp"] >> np.maximum(at, 0).astype(np.uint64)) & np.uint64(1)
        found, active, step = [], np.flatnonzero(after > 0), 1
        while len(active):
            i, j = active, active + step
            met = np.bitwise_count(x["fp"][i] ^ x["fp"][j]) <= most_bits
            i, j = i[met], j[met]
            ok = ((at[i] < 0) | (side[i] != side[j])) & (x["own"][i] | (x["block"][i] != x["block"][j])) & (x["fp"][i] != x["fp"][j])
            found.append(np.stack([i[ok], j[ok]]))
            step += 1
            active = active[after[active] >= step]
        i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
        a, b = x["fp"][i].view(np.int64), x["fp"][j].view(np.int64)
        return np.minimum(a, b), np.maximum(a, b)

    def out(u=(), v=(), back=None) -> pa.RecordBatch:
        none = lambda n, kind: pa.nulls(n, kind)
        if back is None:
            columns = [pa.array(u, pa.int64()), pa.array(v, pa.int64()), none(len(u), pa.int32()), none(len(u), pa.int64())]
        else:
            n = len(back["fp"])
            columns = [none(n, pa.int64()), none(n, pa.int64()), pa.array(back["slot"], pa.int32()), pa.array(back["fp"].view(np.int64), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["u", "v", "slot", "fp"])

    def run(batches):
        held, streamed = None, None  # entries of the last group, which may go on; the hot group that is given back
        for batch in batches:
            x = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
            x["fp"] = x["fp"].view(np.uint64)
            if held is not None:
                x = {name: np.concatenate([held[name], v]) for name, v in x.items()}
            if streamed is not None:
                n = int(np.searchsorted(x["group"], streamed, "right"))
                if n:
                    yield out(back={name: v[:n] for name, v in x.items()})
                x = {name: v[n:] for name, v in x.items()}
                held = None
                if not len(x["fp"]):
                    continue
                streamed = None
            starts = np.append(0, np.flatnonzero(np.diff(x["group"])) + 1) if len(x["fp"]) else np.zeros(0, int)
            if not len(starts):
                continue
            if hot is not None and len(x["fp"]) - starts[-1] > hot:
                streamed = x["group"][-1]
                yield out(back={name: v[starts[-1] :] for name, v in x.items()})
                held = None
            else:
                held = {name: v[starts[-1] :] for name, v in x.items()}
            x = {name: v[: starts[-1]] for name, v in x.items()}
            yield from groups(x, starts[:-1])
        if held is not None:
            yield from groups(held, np.zeros(1, int))

    def groups(x, starts):
        if hot is not None and len(starts):
            sizes = np.diff(np.append(starts, len(x["fp"])))
            large = np.repeat(sizes > hot, sizes)
            if large.any():
                yield out(back={name: v[large] for name, v in x.items()})
                x = {name: v[~large] for name, v in x.items()}
                starts = np.append(0, np.cumsum(sizes[sizes <= hot]))[:-1]
        if len(starts):
            u, v = pairs(x, starts)
            if len(u):
                yield out(u, v)

    return run


def links(prints: DataFrame, most_bits: int = 3, hot: int = 256, blocks: int = 8) -> DataFrame:
    """All pairs (u, v) with u < v of the distinct fingerprints of prints (fp: long) within most_bits (0 gives none).

    A fingerprint is cut into most_bits // 2 + 1 segments, so for each pair one segment differs by one bit at most. The
    index has each segment as it is and, for each of its bits, with that bit deleted. One exchange brings entries of a
    variant together; a pair meets at a deleted bit only if it differs in just that bit. The differing bits of what meets
    are then counted.

    Variants with over hot fingerprints are joined on the bits outside the segment too: those are cut into most_bits + 1
    parts, of which a pair within reach has one equal. These groups are spread over the pairs of blocks of fingerprints. Both
    is exact. A null fingerprint has no links. A table without rows gives none.
    """
    cuts, fp = _cuts(most_bits), F.col("fp")
    kinds = "u long, v long, slot int, fp long"
    rows = prints.select("fp").filter("fp is not null").distinct()
    rows = rows.select("fp", F.explode(_entries(fp, cuts)).alias("e")).select("fp", "e.*")

    def met(rows: DataFrame, on: list[str], own: Column, block: Column, most: int | None) -> DataFrame:
        rows = rows.select("slot", "fp", block.cast("int").alias("block"), own.alias("own"), F.xxhash64(*on).alias("group"))
        return rows.repartition("group").sortWithinPartitions("group").mapInArrow(_meeting(most_bits, cuts, most), kinds)

    first = common.written(met(rows, ["slot", "key"], F.lit(True), F.lit(0), max(hot, 2)), "simhash-pairs")
    rest = F.lit(None).cast("long")  # the bits outside a slot's segment
    for k, (a, b) in enumerate(cuts):
        low = _bits(fp, 0, a) if a else F.lit(0).cast("long")
        high = F.shiftleft(_bits(fp, b, 64), a) if b < 64 else F.lit(0).cast("long")
        rest = F.when(F.floor(F.col("slot") / 65) == k, low.bitwiseOR(high)).otherwise(rest)
    step = max(1, min(64 - (b - a) for a, b in cuts) // (most_bits + 1))
    ends = [(j * step, 64 if j == most_bits else (j + 1) * step) for j in range(most_bits + 1)]
    part = F.explode(F.array(*[F.struct(F.lit(j).alias("part"), _bits(F.col("rest"), a, b).alias("value")) for j, (a, b) in enumerate(ends)]))
    split = first.filter("slot is not null").select("slot", "fp").withColumn("rest", rest)
    split = split.withColumn("key", _key_of("slot", "fp", cuts)).withColumn("p", part).select("slot", "key", "fp", "p.*")
    block = F.pmod(F.xxhash64("fp"), F.lit(blocks)).cast("int")
    split = split.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    split = split.withColumn("least", F.least("block", "other")).withColumn("most", F.greatest("block", "other"))
    second = met(split, ["slot", "key", "part", "value", "least", "most"], F.col("least") == F.col("most"), F.col("block"), None)
    return first.filter("slot is null").select("u", "v").union(second.select("u", "v")).distinct()


def _key_of(slot: str, fp: str, cuts: list[tuple[int, int]]) -> Column:
    """The key that _entries() gives a fingerprint in a slot."""
    out = F.lit(None).cast("long")
    for k, (a, b) in enumerate(cuts):
        bit = F.col(slot) - 65 * k - 1
        one = F.when(bit >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))
        out = F.when(F.floor(F.col(slot) / 65) == k, _bits(F.col(fp), a, b).bitwiseAND(F.bitwise_not(one))).otherwise(out)
    return out


def _classes(rows: DataFrame, most_bits: int) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, fp, ...) as a written table, and (fp, root) of every distinct fingerprint."""
    rows = common.written(rows, "fingerprints")
    roots = connected_components(links(rows, most_bits))
    nodes = rows.select("fp").distinct().join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rows, common.written(nodes.select("fp", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")


def near_duplicates(
    docs: DataFrame, *, most_bits: int = 3, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each document: doc_id, fp (signed long) and component_id.

    component_id is the smallest doc_id that links of most_bits or fewer differing bits reach, the
    document itself included. Equal fingerprints are one node, so copies never become pairs. Null and
    empty texts have fingerprint 0 and are linked like any other. Null ids are kept; they are no
    component's id unless it has no other. Repeated rows stay. Very long texts are hashed whole. A bit set in just half
    of the hashes is 0. An empty table gives no rows. Columns other than the two are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprints(F.col(text_col), shingle_words).alias("fp"))
    rows, roots = _classes(rows, most_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    least = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(roots.join(least, "root"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, *, most_bits: int = 3, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs, all columns, with one row of each group of near duplicates: the one with the smallest id.

    A null id comes last; of equal ids the one of the smallest hash of its text stays. Rows alike in id and text count as
    one row. Texts as in near_duplicates().
    """
    key = {  # 128 bits of id and text
        "_key_a": F.xxhash64(F.lit(1), F.col(id_col).cast("long"), text_col),
        "_key_b": F.xxhash64(F.lit(2), text_col, F.col(id_col).cast("long")),
    }
    prints = fingerprints(F.col(text_col), shingle_words)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[v.alias(k) for k, v in key.items()], prints.alias("fp"))
    rows, roots = _classes(rows, most_bits)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key_a", "_key_b")
    kept = rows.join(roots, "fp").groupBy("root").agg(F.min(order).alias("first"))
    kept = kept.select("first._key_a", "first._key_b")
    found = docs.withColumns(key).join(kept, [*key]).dropDuplicates([*key])
    return found.select(docs.columns)
