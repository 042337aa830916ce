"""Shards of near equal bytes: histogram sort over a key, then one exchange."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Bracket:
    """Where a splitter is known to lie: a to b, both included, of the keys, or of the ties of one key."""

    a: int
    b: int
    below: int = 0  # exact bytes of all rows before a
    key: int | None = None

    def step(self, probes: int) -> int:
        return -(-(self.b - self.a + 1) // probes)

    def first(self) -> tuple[int, int]:
        """The first (key, tie) it holds."""
        return (self.a, LOW) if self.key is None else (self.key, self.a)


def _below(points: list[tuple[int, int]]) -> Column:
    """How many of the sorted points (key, tie) are at or before a row's (key, tie), by binary search in a literal array.

    The expression grows with the logarithm of their number.
    """
    if not points:
        return F.lit(0)
    pairs = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for k, t in points])
    own = F.struct(F.col("key").alias("k"), F.col("tie").alias("t"))
    rounds = F.sequence(F.lit(1), F.lit(len(points).bit_length()))

    def step(state: Column, _: Column) -> Column:  # low to high, both included, hold the number
        middle = F.shiftright(state["low"] + state["high"] + 1, 1)
        open_ = state["low"] < state["high"]
        reached = F.get(pairs, middle - 1) <= own
        low = F.when(open_ & reached, middle).otherwise(state["low"])
        high = F.when(open_ & ~reached, middle - 1).otherwise(state["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(points)).alias("high"))
    return F.aggregate(rounds, start, step, lambda state: state["low"])


def _histograms(rows: DataFrame, brackets: list[Bracket], probes: int) -> list[dict[int, int]]:
    """Exact bytes by bin of every bracket, over all partitions. Brackets do not overlap.

    A row meets its bracket in a join with the brackets, one row each; only sums go through an exchange. The driver gets
    probes numbers for each bracket at most, whatever the number of rows.
    """
    spark = rows.sparkSession
    ordered = sorted(range(len(brackets)), key=lambda k: brackets[k].first())
    data = [(n, brackets[k].a, brackets[k].b, brackets[k].key, brackets[k].step(probes)) for n, k in enumerate(ordered)]
    table = spark.createDataFrame([(n, a, b, key, Decimal(step)) for n, a, b, key, step in data], "n int, a long, b long, at long, step decimal(20,0)")
    rows = rows.select("size", "key", "tie", (_below([brackets[k].first() for k in ordered]) - 1).alias("n"))
    rows = rows.join(F.broadcast(table), "n")  # a row for each splitter
    value = F.when(F.col("at").isNull(), F.col("key")).otherwise(F.col("tie"))
    inside = value.between(F.col("a"), F.col("b")) & (F.col("at").isNull() | (F.col("key") == F.col("at")))
    bin_ = F.expr("(cast(v as decimal(20, 0)) - cast(a as decimal(20, 0))) div step")
    counted = rows.filter(inside).withColumn("v", value).select("n", bin_.alias("bin"), "size")
    found: list[dict[int, int]] = [{} for _ in brackets]
    for r in counted.groupBy("n", "bin").agg(F.sum("size").alias("size")).collect():
        found[ordered[r.n]][r.bin] = r["size"]
    return found


def _narrowed(x: Bracket, target: int, bins: dict[int, int], probes: int, tolerance: float) -> Bracket | tuple[int, int]:
    """The splitter (key, tie) if a bin's edge is near enough to target; else the bin that target falls into."""
    point = lambda edge: (edge, LOW) if x.key is None else (x.key, edge)
    step, below = x.step(probes), x.below
    for k in sorted(bins):
        a, b = x.a + k * step, min(x.a + (k + 1) * step - 1, x.b)
        if abs(below - target) <= tolerance:
            return point(a)
        if below + bins[k] > target:
            if a == b and x.key is None:
                return Bracket(LOW, HIGH, below, a)  # one key: go on among its ties
            if a == b or below + bins[k] - target <= tolerance and b < HIGH:
                return point(a) if a == b else point(b + 1)
            return Bracket(a, b, below, x.key)
        below += bins[k]
    return point(x.b)  # nothing is left above


def splitters(rows: DataFrame, shards: int, *, tolerance: float = 0.001, probes: int = 256) -> list[tuple[int, int]]:
    """shards - 1 pairs (key, tie) that cut rows (key, tie, size: long) into shards of near equal size.

    A row is before a splitter if its pair is smaller. Each round counts, over all partitions, the exact
    bytes below probes candidate boundaries within each splitter's bracket, and keeps the bin where the
    target falls. It ends when the bytes below each splitter are within tolerance * (the mean shard) of the
    target, or the bracket is a single (key, tie).
    """
    low, high, total = rows.agg(F.min("key"), F.max("key"), F.sum("size")).first()
    if total is None:
        return [(LOW, LOW)] * (shards - 1)
    targets = [total * i // shards for i in range(1, shards)]
    found: list[Bracket | tuple[int, int]] = [Bracket(low, high)] * (shards - 1)
    while open_ := list(dict.fromkeys(x for x in found if isinstance(x, Bracket))):
        bins = dict(zip(open_, _histograms(rows, open_, probes), strict=True))
        found = [
            _narrowed(x, t, bins[x], probes, tolerance * total / shards) if isinstance(x, Bracket) else x
            for x, t in zip(found, targets, strict=True)
        ]
    return sorted(found)


def shard(
    docs: DataFrame, shards: int = 16, *, tolerance: float = 0.001, part_bytes: int = 64 << 20,
    key_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """docs with columns size, shard and slot: shards of near equal bytes, each a range of keys.

    size is the UTF-8 bytes of the text (null: none) plus 1. Rows of one key, as with a null or repeated
    one, are cut at a tie: a hash of the row's place in the input, the same for splitters and rows. So a key, or one row
    repeated, that holds many rows is spread over shards too. Once splitters are known, one exchange sorts all rows into
    parts of about part_bytes; they are written to the shared folder, a folder for each shard. slot numbers a shard's rows in
    the order of keys, gapless from 0: from a row's place in its part and the number of rows in the shard's parts before.

    Null keys sort first. A very long text is one row: a shard can be larger than the mean by it. Rows that are alike
    keep a slot each, in any order. An empty table gives no rows. Input columns named size, shard or slot are replaced.
    """
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    rows = common.placed(docs, "_place").select(*kept, common.text_size(text_col).alias("size"), "_place")
    pair = {"_key": F.coalesce(F.col(key_col).cast("long"), F.lit(LOW).cast("long")), "_tie": F.xxhash64(key_col, "_place")}
    rows = rows.withColumns(pair).drop("_place")
    keys = rows.select(F.col("_key").alias("key"), F.col("_tie").alias("tie"), "size")
    keys = common.written(keys, "shard-keys")
    bounds = splitters(keys, shards, tolerance=tolerance)
    total = keys.agg(F.sum("size")).first()[0] or 0
    number = _below(bounds)
    rows = rows.withColumnsRenamed({c: f"_in_{c}" for c in kept}).withColumnsRenamed({"_key": "key", "_tie": "tie"})
    rows = rows.withColumn("shard", number.cast("int")).withColumnsRenamed({"key": "_key", "tie": "_tie"}).withColumnsRenamed({f"_in_{c}": c for c in kept})
    order = ("shard", "_key", "_tie")
    parts = max(shards, -(-total // part_bytes))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).drop("_key", "_tie")  # part, then place in it
    rows = common.written(rows, "shards", by="shard").withColumn("_part", F.shiftright("_at", 33))
    own = rows.groupBy("shard", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # parts, not rows
    own = common.written(own.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "shard-parts")
    own = common.small(own, 500_000)
    rows = rows.join(own, ["shard", "_part"]).withColumn("slot", F.col("_base") + F.col("_at") - F.col("_first"))
    return rows.select(*kept, "size", "shard", "slot")
