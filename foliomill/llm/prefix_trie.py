"""The trie of conversation prefixes: subtree totals by leaf peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common

#: SHA-256 of no bytes.
EMPTY = hashlib.sha256().hexdigest()
#: Words of 32 bits that together are a turn's digest; sums of these do not overflow.
WORDS = ("w0", "w1", "w2", "w3")


def running(rows: DataFrame, key: str, order: Sequence[Column], sums: Sequence[str], keep: Sequence[str], name: str) -> DataFrame:
    """keep columns of rows as a written table; columns in sums (long, none negative) have the sum over a key's rows up to
    this one, in order.

    Rows are dealt by ranges of (key, order), so a key of many rows is in many tasks, and each task sums what it
    has. A key that goes on in a further task gets the sums of the tasks before; there is at most one such key in a task, so
    these are fewer rows than there are tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, F.col(key), *order).sortWithinPartitions(F.col(key), *order).select(*keep)
    at, k = [rows.columns.index(c) for c in sums], rows.columns.index(key)

    def run(batches):
        last, carried = None, np.zeros(len(at), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, columns = batch.column(k).to_numpy(), list(batch.columns)
            new = np.append([last is None or keys[0] != last], keys[1:] != keys[:-1])
            starts, own = np.flatnonzero(new), np.cumsum(new) - 1  # own: -1 for the key that goes on from the batch before
            for j, i in enumerate(at):
                each = batch.column(i).to_numpy()
                total = np.cumsum(each)
                total = total - np.append((total - each)[starts], -carried[j])[own]
                carried[j] = total[-1]
                columns[i] = pa.array(total)
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    part = common.written(rows.mapInArrow(run, rows.schema).withColumn("_part", F.spark_partition_id()), name)
    ends = part.groupBy(key, "_part").agg(*[F.max(c).alias(f"_{c}") for c in sums])
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over a key's tasks
    later = ends.select(key, "_part", *[F.sum(f"_{c}").over(before).alias(f"_{c}") for c in sums]).filter(F.col(f"_{sums[0]}").isNotNull())
    out = part.join(F.broadcast(later), [key, "_part"], "left")
    return out.select(*[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) if c in sums else c for c in keep])


def _node(depth: str, words: Sequence[str]) -> tuple[Column, Column]:
    """128 bits for a prefix of that depth, of the sums of its turns' digests; a digest holds its turn's place."""
    return F.xxhash64(depth, *words), F.xxhash64(*reversed(words), depth)


def rebuilt(conversations: DataFrame, every: int, most_taken: int) -> tuple[DataFrame, DataFrame]:
    """(c, depth, a, b, up_a, up_b, bytes, last) of the turns of rebuilt conversations: the node of each, the one above, bytes of the text and
    whether the conversation ends there; and (c) of conversations without turns."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("c"), "turn", text("role").alias("role"), text("text").alias("text"))
    turns = turns.filter("c is not null").withColumns({
        "p": F.lit(1).cast("long"), "t0": F.xxhash64("role", "text"), "t1": F.xxhash64(F.lit(7), "text", "role"),
        "bytes": F.octet_length("text").cast("long"),
    })
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = running(turns, "c", order, ["p"], ["c", "p", "t0", "t1", "bytes"], "trie-turns")
    taken = F.crc32(F.col("c").cast("string")) % (most_taken + 1)
    sizes = rows.groupBy("c").agg(F.max("p").alias("n")).withColumns({"taken": taken, "base": F.col("c") - F.col("c") % every})
    bases = sizes.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    sizes = sizes.join(bases, "base", "left").withColumn("first", F.least("taken", F.coalesce("n_base", F.lit(0))))
    sizes = sizes.withColumn("length", F.col("first") + F.greatest(F.col("n") - F.col("taken"), F.lit(0)))
    sizes = common.written(sizes.select("c", "base", "taken", "first", "length"), "trie-sizes")
    firsts = rows.filter(F.col("p") <= most_taken).withColumnRenamed("c", "base")
    begun = sizes.select("c", "base", "first", "length").join(firsts, "base").filter("p <= first").select("c", F.col("p").alias("depth"), "length", "t0", "t1", "bytes")
    own = rows.join(sizes.select("c", "taken", "first", "length"), "c").filter("p > taken")
    own = own.select("c", (F.col("p") - F.col("taken") + F.col("first")).alias("depth"), "length", "t0", "t1", "bytes")
    digests = {"x": F.xxhash64("depth", "t0", "t1"), "y": F.xxhash64("t1", "t0", "depth")}
    low = F.lit((1 << 32) - 1).cast("long")
    whole = begun.unionByName(own).withColumns(digests)
    whole = whole.withColumns({"w0": F.col("x").bitwiseAND(low), "w1": F.shiftrightunsigned("x", 32), "w2": F.col("y").bitwiseAND(low), "w3": F.shiftrightunsigned("y", 32)})
    whole = whole.withColumns({f"own_{w}": F.col(w) for w in WORDS})
    keep = ["c", "depth", "length", "bytes", *WORDS, *[f"own_{w}" for w in WORDS]]
    whole = running(whole, "c", [F.col("depth")], WORDS, keep, "trie-prefixes")
    a, b = _node("depth", WORDS)
    whole = whole.withColumns({"a": a, "b": b, "above": F.col("depth") - 1} | {f"own_{w}": F.col(w) - F.col(f"own_{w}") for w in WORDS})
    up_a, up_b = _node("above", [f"own_{w}" for w in WORDS])
    whole = whole.select("c", "depth", "a", "b", up_a.alias("up_a"), up_b.alias("up_b"), "bytes", (F.col("depth") == F.col("length")).alias("last"))
    return whole, sizes.filter("length = 0").select("c")


def _texts(batches, most: int = 4096):
    """(a, b, first, ids) of sorted (a, b, c): runs of a node's ids, comma-joined, most in one."""
    key, ids = None, []
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out = []
        for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if ids and ((a, b) != key or len(ids) == most):
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = (a, b)
            ids.append(c)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, ids[0], ",".join(map(str, ids))), kinds, strict=True)], schema=kinds)


def _hashes(batches):
    """(a, b, sha) of runs sorted by (a, b, first), a run at a time."""
    key, sha = None, None
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sha", pa.string())])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (a, b), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield batch_of(out)
    if key is not None:
        yield batch_of([(*key, sha.hexdigest())])


def id_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the ids c that end at a node, in order, comma-joined.

    Ids are sorted by ranges of (node, id), so a node at which many end is in many tasks; each joins runs of ids, and a node's
    runs then go through one hash, one after the other.
    """
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ends.select("a", "b", "c").repartitionByRange(n, "a", "b", "c").sortWithinPartitions("a", "b", "c")
    runs = runs.mapInArrow(_texts, "a long, b long, first long, ids string")
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashes, "a long, b long, sha string")


def peeled(paths: DataFrame, most_rounds: int = 10_000) -> DataFrame:
    """(path, parent, at, leaves, saved): subtree totals of paths (path, parent, at, leaves, saved, remaining).

    remaining counts a path's children that are not done. In a round, paths with none left are done and send their
    totals to their parents, which add them and count down. It ends when the root is done. Only what is not done is written
    again, and messages are summed before they move.
    """
    pending, done = common.written(paths, "trie-pending"), []
    for _ in range(most_rounds):
        done.append(common.written(pending.filter("remaining = 0").drop("remaining"), "trie-done"))
        rest = pending.filter("remaining > 0")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
        sent = done[-1].filter("parent is not null").groupBy(F.col("parent").alias("path"))
        sent = sent.agg(F.count("*").alias("n_"), F.sum("leaves").alias("leaves_"), F.sum("saved").alias("saved_"))
        rest = rest.join(sent, "path", "left")
        added = {c: F.col(c) + F.coalesce(F.col(f"{c}_"), F.lit(0)) for c in ("leaves", "saved")}
        rest = rest.withColumns(added | {"remaining": F.col("remaining") - F.coalesce("n_", F.lit(0))})
        pending = common.written(rest.select(*paths.columns), "trie-pending")
    raise RuntimeError("peeling did not end")


def prefix_trie(conversations: DataFrame, *, every: int = 5, most_taken: int = 8) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, each long but the last.

    Conversation c is rebuilt as the first h turns of c - c % every (all, if fewer; none, if absent) and its own after its
    first h, with h = crc32 of c in decimal % (most_taken + 1). A node is a distinct sequence of first turns (role, text).

    Nodes with the same smallest member c are one stretch of c's path and count as one node of the peeling: it holds
    how many stretches hang from it, and leaves are peeled round by round until the root is done (see peeled()). There
    are as many rounds as stretches hang from one another. Sums along a path, by depth and for prefixes, are taken over ranges of
    rows, so one conversation may hold most turns and one node most conversations. Texts move once, to be sorted.

    Turns are ordered by turn, null first, then by role and text; null roles and texts are empty; repeated rows are turns of their
    own. Rows without a conv_id are left out. A long text is one row, hashed whole. A negative conv_id keeps the
    sign in %. Sequences are told apart by 128 bits. No conversations give no rows. Other columns are not read.
    """
    if every < 1 or most_taken < 0:
        raise ValueError("every is 1 and most_taken 0 at least")
    spark = conversations.sparkSession
    rows, turnless = rebuilt(conversations, every, most_taken)
    rows = common.written(rows, "trie-rows")
    zero = spark.range(1).select(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(w) for w in WORDS])
    root_a, root_b = zero.select(*_node("depth", WORDS)).first()
    root = [F.lit(root_a).cast("long").alias("a"), F.lit(root_b).cast("long").alias("b")]
    ends = rows.filter("last").select("a", "b", "c").unionByName(turnless.select(*root, "c"))

    nodes = rows.groupBy("a", "b").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.min(F.struct("depth", "bytes", "up_a", "up_b")).alias("own"))
    nodes = nodes.select("a", "b", "conv_id", "n_convs", "own.*")
    ids = rows.filter("depth = 1").select("c").unionByName(turnless)
    top = ids.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    none = [F.lit(None).cast("long").alias(c) for c in ("up_a", "up_b")]
    top = top.select(*root, "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), *none)
    nodes = nodes.unionByName(top).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = common.written(nodes, "trie-nodes")

    # A stretch: nodes of one smallest member, from depth top to bottom
    stretch = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "up_a", "up_b")).alias("t"), F.max("depth").alias("bottom"), F.sum("saved").alias("saved"))
    stretch = stretch.select(F.col("conv_id").alias("path"), F.col("t.depth").alias("top"), F.col("t.up_a").alias("up_a"), F.col("t.up_b").alias("up_b"), "bottom", "saved")
    above = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"), F.col("depth").alias("at"))
    stretch = common.written(stretch.join(above, ["up_a", "up_b"], "left").drop("up_a", "up_b"), "trie-stretches")
    hanging = stretch.filter("parent is not null").groupBy("parent", "at").agg(F.count("*").alias("n"))
    counts = hanging.groupBy(F.col("parent").alias("path")).agg(F.sum("n").alias("remaining"))
    at_end = hanging.select(F.col("parent").alias("path"), F.col("at").alias("bottom"), F.lit(0).cast("long").alias("leaves"))
    paths = stretch.join(counts, "path", "left").join(at_end, ["path", "bottom"], "left")
    zero = F.lit(0).cast("long")
    paths = paths.select("path", "parent", "at", F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves"), "saved", F.coalesce("remaining", zero).alias("remaining"))
    done = peeled(paths)

    sides = done.filter("parent is not null").groupBy(F.col("parent").alias("conv_id"), F.col("at").alias("depth"))
    sides = sides.agg(F.count("*").alias("kids"), F.sum("leaves").alias("side_leaves"), F.sum("saved").alias("side_saved"))
    first = stretch.select(F.col("path").alias("conv_id"), F.col("top").alias("depth"), F.col("parent").alias("up"), F.lit(True).alias("is_top"))
    last = stretch.select(F.col("path").alias("conv_id"), F.col("bottom").alias("depth"), F.lit(True).alias("is_bottom"))
    nodes = nodes.select("a", "b", "conv_id", "depth", "n_convs", "saved").join(id_hashes(ends), ["a", "b"], "left")
    for other in (sides, first, last):
        nodes = nodes.join(other, ["conv_id", "depth"], "left")
    children = F.coalesce("kids", zero) + F.when(F.col("is_bottom"), 0).otherwise(1)
    nodes = nodes.select(
        "conv_id", "depth", F.when(F.col("is_top"), F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs", children.alias("n_children"),
        (F.coalesce("side_leaves", zero) + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("side_saved", zero)).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"),
    )
    return running(nodes, "conv_id", [F.col("depth").desc()], ["n_leaves", "saved_tokens"], nodes.columns, "trie")
