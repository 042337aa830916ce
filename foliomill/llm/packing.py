"""Packing documents into training sequences with a bounded number of open windows for each partition."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common

#: sequence_id of the sequences that the merge makes: above those of all partitions.
MERGED = 1 << 62

_FIELDS = {
    "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(), "ids": pa.binary(), "left_over": pa.int32(),
}


class Windows:
    """Open windows of one partition. Pieces go where they fit best; the fullest leaves when none fits."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[tuple[int, int]] = []  # (free ids, number), sorted
        self.pieces: dict[int, list] = {}
        self.number = 0

    def place(self, n: int, piece) -> list[list]:
        """Windows that this leaves to be written, each a list of (offset, piece)."""
        done = []
        k = bisect_left(self.free, (n, -1))
        if k < len(self.free):
            free, window = self.free.pop(k)
        else:
            if len(self.free) >= self.most:
                done.append(self.pieces.pop(self.free.pop(0)[1]))
            free, window = self.size, self.number
            self.pieces[window] = []
            self.number += 1
        self.pieces[window].append((self.size - free, piece))
        if free == n:
            done.append(self.pieces.pop(window))
        else:
            insort(self.free, (free - n, window))
        return done

    def rest(self) -> list[list]:
        return list(self.pieces.values())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _FIELDS.values(), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], list(_FIELDS))


def pack(
    docs: DataFrame, tokenizer: str, *, end_id: int, window: int = 4096, open_windows: int = 64,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode every whole text, append end_id, and pack the ids into sequences of at most window ids.

    Each input partition is packed as it streams by, without a shuffle. Runs of window ids are cut off
    the front of a long document as full sequences; what is left is placed into the open window where
    it fits best. When it fits none and open_windows are open, the fullest is written and a new one is
    opened, so memory is bounded by open_windows * window ids. The windows still open when partitions
    end are merged: their ids, in the order of partitions, are cut every window ids. All sequences of
    the merge but the last are full. (Cuts only fall into leftovers, open_windows to a partition.)

    Returns a row for each piece: doc_id, start (ids of its document before it), length, doc_tokens (with
    the end id), sequence_id, offset (in the sequence, gapless from 0), ids (little-endian unsigned
    32-bit). Null texts are empty: one piece with the end id. Very long texts are cut into full sequences as they stream
    by. Of windows that fit equally the oldest is taken. Null ids are kept. Repeated rows are packed each for itself. An empty
    table gives no rows. Other columns are not read.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        windows, rows, size = Windows(window, open_windows), [], 0
        sequence = TaskContext.get().partitionId() << 32
        encode = common.encoder(tokenizer).encode
        width = 4 * window
        for batch in common.small_batches(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                full = len(ids) - len(ids) % width
                done = [[(0, (doc_id, a // 4, window, n, ids[a : a + width]))] for a in range(0, full, width)]
                if full < len(ids):
                    done += windows.place(n - full // 4, (doc_id, full // 4, n - full // 4, n, ids[full:]))
                for pieces in done:
                    rows += [(*p[:4], sequence, at, p[4], 0) for at, p in pieces]
                    sequence += 1
                    size += 1
                if size >= 256:
                    yield _batch(rows)
                    rows, size = [], 0
        for pieces in windows.rest():
            rows += [(*p[:4], sequence, at, p[4], 1) for at, p in pieces]
            sequence += 1
        if rows:
            yield _batch(rows)

    kinds = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, left_over int"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = common.written(rows.mapInArrow(run, kinds), "packed", by="left_over")
    columns = [x for x in _FIELDS if x != "left_over"]
    whole = packed.filter("left_over = 0").select(columns)
    return whole.unionByName(_merged(packed.filter("left_over = 1").select(columns), window))


def _merged(pieces: DataFrame, window: int) -> DataFrame:
    """The open windows' ids one after the other, cut every window ids.

    A piece's place is the ids in all partitions before plus those before it in its own partition, which
    has a bounded number of open windows.
    """
    pieces = pieces.withColumn("part", F.shiftright("sequence_id", 32))
    totals = pieces.groupBy("part").agg(F.sum("length").alias("total"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("sequence_id", "offset").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    pieces = pieces.join(totals, "part").withColumn("at", F.col("base") + F.col("inside"))
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("length") - 1) / window)
    pieces = pieces.withColumn("n", F.explode(F.sequence(first, last)))
    a = F.greatest(F.col("n") * window - F.col("at"), F.lit(0))  # the part of the piece in sequence n
    b = F.least((F.col("n") + 1) * window - F.col("at"), F.col("length"))
    pieces = pieces.withColumn("a", a).withColumn("cut", b - F.col("a"))
    return pieces.select(
        "doc_id", (F.col("start") + F.col("a")).alias("start"), F.col("cut").alias("length"), "doc_tokens",
        (F.col("n") + F.lit(MERGED)).alias("sequence_id"), (F.col("at") + F.col("a") - F.col("n") * window).alias("offset"),
        F.substring("ids", (F.col("a") * 4 + 1).cast("int"), (F.col("cut") * 4).cast("int")).alias("ids"),
    )
