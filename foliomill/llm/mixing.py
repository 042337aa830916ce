"""Mixing sources to target weights: Pfair windows for each source's blocks, earliest deadline first."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common

#: The schedule is broadcast up to this many of its numbers (8 MB), and joined by source and run of blocks beyond.
BROADCAST_NUMBERS = 1_000_000


class Blocks(dict):
    """Blocks of each source, with the whole-numbered weights they are dealt by."""

    def __init__(self, blocks: Mapping[str, int], weights: Mapping[str, int]):
        super().__init__(blocks)
        self.weights = dict(weights)


def exact(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in the very proportions of the weights."""
    as_fractions = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in as_fractions.values()))
    return {s: int(x * scale) for s, x in as_fractions.items()}


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], cycle: int = 1024) -> list[tuple[Blocks, int]]:
    """(blocks of each source, 1), one after the other: the sources with a weight, then those without.

    Sources without a weight are dealt by their sizes. Weights are not rounded, whatever the cycle.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    heavy = {s: weights[s] for s in left if weights.get(s, 0) > 0}
    light = {s: n for s, n in left.items() if s not in heavy}
    out = [(Blocks({s: left[s] for s in heavy}, exact(heavy)), 1)] if heavy else []
    return out + ([(Blocks(light, light), 1)] if light else [])


class Fluid:
    """The fluid mix: one block a slot, of all sources that last, by their weights.

    It has had x * w blocks of a source of weight w, or all of it, at a time that grows by straight pieces in x; a piece
    ends where a source does.
    """

    def __init__(self, blocks: Mapping[str, int], weights: Mapping[str, int]):
        order = sorted(blocks, key=lambda s: Fraction(blocks[s], weights[s]))
        self.ends = [Fraction(blocks[s], weights[s]) for s in order]
        self.ended, self.active = [0], [sum(weights[s] for s in blocks)]
        for s in order:
            self.ended.append(self.ended[-1] + blocks[s])
            self.active.append(self.active[-1] - weights[s])

    def windows(self, n: int, weight: int) -> Iterator[tuple[int, int]]:
        """(floor, ceiling) of the times at which it has had 0, 1, ... n blocks of a source."""
        i = 0
        for k in range(n + 1):
            if i < len(self.ends) and k * self.ends[i].denominator >= self.ends[i].numerator * weight:
                i = bisect_right(self.ends, Fraction(k, weight), i)
            parts = k * self.active[i]
            yield self.ended[i] + parts // weight, self.ended[i] - (-parts // weight)


def dealt(blocks: Mapping[str, int], weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot.

    A block is released at the slot in which the fluid mix starts it and due by the end of that in which it ends.
    Taking the earliest deadline among released blocks meets every deadline, so after any number of slots
    a source has had less than one block more or less than in the fluid mix, also where others have ended.
    """
    fluid = Fluid(blocks, weights)
    windows = {s: fluid.windows(n, weights[s]) for s, n in blocks.items()}
    release = {s: next(w)[0] for s, w in windows.items()}
    waiting = [(release[s], s) for s in sorted(blocks)]  # (release, source) of each source's next block
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    left = dict(blocks)
    for t in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= t:
            s = heapq.heappop(waiting)[1]
            release[s], due = next(windows[s])
            heapq.heappush(ready, (due, s))
        due, s = heapq.heappop(ready)
        assert t < due, "a deadline was missed"
        yield s
        left[s] -= 1
        if left[s]:
            heapq.heappush(waiting, (release[s], s))


def schedule(share: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks; without weights of their own, blocks are dealt by their numbers."""
    slots: dict[str, list[int]] = {s: [] for s in share}
    for t, s in enumerate(dealt(share, getattr(share, "weights", share))):
        slots[s].append(t)
    return slots


def _plan(spark, steps: list[tuple[Blocks, int]], cycle: int) -> DataFrame:
    """(source, part, slots): the slots of cycle blocks of a source, the part-th such run of them. A task deals a step
    slot by slot and keeps at most one run of each source."""
    bases = [sum(sum(share.values()) for share, _ in steps[:i]) for i in range(len(steps))]

    def run(batches):
        for pdf in batches:
            for i in pdf["id"]:
                share, base = steps[i][0], bases[i]
                slots, part, rows = {s: [] for s in share}, dict.fromkeys(share, 0), []
                for t, s in enumerate(dealt(share, share.weights), base):
                    slots[s].append(t)
                    if len(slots[s]) == cycle:
                        rows.append((s, part[s], slots[s]))
                        slots[s], part[s] = [], part[s] + 1
                    if len(rows) == 64:
                        yield pd.DataFrame(rows, columns=["source", "part", "slots"])
                        rows = []
                rows += [(s, part[s], x) for s, x in slots.items() if x]
                yield pd.DataFrame(rows, columns=["source", "part", "slots"])

    return spark.range(0, len(steps), 1, max(1, len(steps))).mapInPandas(run, "source string, part long, slots array<long>")


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, temperature: float = 0.7, block_bytes: int = 1 << 18,
    most_slots: int = 4_000_000, cycle: int = 1024, most_sources: int = 100_000, part_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """All rows of docs, in partitions and rows ordered by an interleaving of their sources.

    A source's rows, in the order of a hash and then the id, are cut into blocks of block_bytes (UTF-8
    bytes of the text plus 1; a row belongs where it begins), or of as many more as keep the blocks of all at most_slots, so that
    dealing them stays a matter of seconds however large the corpus is. Blocks are laid out by Pfair windows and
    earliest deadlines, so at any point a source's blocks differ from what its weight asks for by less than
    one. A source that ends leaves the others their weights among themselves: every row comes once, none is
    repeated or dropped. Weights are taken as they are, not rounded.

    weights: by source; without them, each source's bytes to the power of temperature. A null source is a
    source of its own. Sources without a weight come when all others have ended. The driver has a row for each
    source, most_sources at most (more raise ValueError: a mix is of named sources, not of keys); a task deals the slots,
    which become a table with a row for each cycle blocks of a source. Rows stay in Spark: running sums within (hash part,
    source), whose totals give each part's offset. The hash holds the row's place in the input, so neither a source with
    most of the rows nor rows that are alike gather in one part; there are parts enough for part_bytes each.

    Adds block_, slot_ and size_ (input columns of these names are replaced). Null texts and null ids are
    rows like others; a very long text is a block, or several slots' worth, by itself; rows that are alike are each kept,
    in any order among themselves. An empty table gives no rows. The order lies in partitions and rows: what is written
    and read again has it by slot_, or by common.in_written_order().
    """
    spark = docs.sparkSession
    added = ("block_", "slot_", "size_")
    kept = [c for c in docs.columns if c not in added]
    rows = common.placed(docs, "_place").select(*kept, common.text_size(text_col).alias("size_"), "_place")
    rows = rows.withColumn("_source", F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), source_col)))
    by_source = {r["_source"]: r["n"] for r in rows.groupBy("_source").agg(F.sum("size_").alias("n")).limit(most_sources + 1).collect()}
    if len(by_source) > most_sources:
        raise ValueError(f"over {most_sources} sources")
    block_bytes = max(block_bytes, -(-sum(by_source.values()) // most_slots))
    parts = common.parts_for(spark, sum(by_source.values()), part_bytes)
    rows = rows.withColumn("_hash", F.xxhash64(id_col, text_col, "_place")).withColumn("_part", F.pmod("_hash", F.lit(parts)).cast("int")).drop("_place")

    totals = common.written(rows.groupBy("_part", "_source").agg(F.sum("size_").alias("_bytes")), "mix-totals")
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", "_source", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_offset"))
    blocks = {s: -(-n // block_bytes) for s, n in by_source.items()}
    if weights is None:
        target = {s: n**temperature for s, n in by_source.items()}
    else:
        target = {"n" if s is None else f"s{s}": w for s, w in weights.items()}
    steps = phases(blocks, target, cycle)
    n_slots = sum(blocks.values())
    plan = _plan(spark, steps, cycle).withColumnsRenamed({"source": "_source", "part": "_run"})
    if n_slots <= BROADCAST_NUMBERS:
        plan = F.broadcast(plan)

    inside = Window.partitionBy("_part", "_source").orderBy("_hash", id_col).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size_").over(inside), F.lit(0))).join(offsets, ["_part", "_source"])
    rows = rows.withColumn("_start", F.col("_start") + F.col("_offset"))
    rows = rows.withColumn("block_", F.floor(F.col("_start") / block_bytes)).withColumn("_run", F.floor(F.col("block_") / cycle))
    rows = rows.join(plan, ["_source", "_run"])
    rows = rows.withColumn("slot_", F.get("slots", (F.col("block_") % cycle).cast("int"))).drop("slots")
    n_out = parts
    at = F.floor(F.col("slot_") * n_out / max(1, n_slots)).cast("int")
    rows = rows.repartitionById(n_out, at).sortWithinPartitions("slot_", "_start")
    return rows.select(*kept, *added)
