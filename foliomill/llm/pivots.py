"""Near-duplicate vectors by a pivot-permutation index: a vector is described by its nearest reference points, in order."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm import common
from foliomill.llm.components import connected_components

#: (nearest points whose pairs are lists, nearest points that are counted, how many two vectors have to share), from the cheapest on.
DESCRIPTIONS = ((6, 8, 3), (8, 12, 3), (10, 16, 3), (12, 24, 2), (16, 32, 2))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def separated(x: np.ndarray, most: int, least_cosines: tuple[float, ...] = (0.8, 0.9, 0.95), enough: int = 64) -> np.ndarray:
    """At most most rows of x (of length one), each taken if its cosine with all taken ones is below the first of least_cosines that
    leaves enough of them. So a dense cluster has one reference point, not as many as its share of the rows."""
    taken = x[:0]
    for limit in least_cosines:
        rest, own = x, []
        while len(rest) and len(own) < most:
            own.append(rest[0].copy())  # a view would hold all of rest
            rest = rest[rest @ rest[0] < limit]
        if len(own) > len(taken):
            taken = np.array(own)
        if len(taken) >= min(enough, most):
            break
    return taken


def nearest_points(x: np.ndarray, points: np.ndarray, m: int) -> np.ndarray:
    """Numbers of the m points nearest to each row, the nearest first."""
    near = x.astype(np.float32) @ points.T.astype(np.float32)
    best = np.argpartition(-near, m - 1, axis=1)[:, :m] if m < near.shape[1] else np.broadcast_to(np.arange(m), near.shape)
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable"), 1)


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many numbers the rows of a and of b have in common, each row without repeats."""
    return (a[:, :, None] == b[:, None, :]).sum((1, 2))


def fit(x: np.ndarray, threshold: float, *, most_points: int, least_recall: float = 0.998) -> tuple[np.ndarray, tuple[int, int, int]]:
    """Reference points and the cheapest description that finds least_recall of pairs planted at just the threshold.

    A planted pair is a row and itself turned towards another row, so it lies where the data do. Where no description finds as
    many, there is one point, whose list has every vector: then all pairs of a label are compared, in blocks.
    """
    points = separated(x, most_points)
    other = np.roll(x, 1, axis=0)
    aside = other - (other * x).sum(1, keepdims=True) * x
    size = np.sqrt((aside * aside).sum(1, keepdims=True))
    fine = size[:, 0] > 1e-6
    near = threshold * x[fine] + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside[fine] / size[fine]
    for lead, counted, least in DESCRIPTIONS:
        if counted > len(points) or not len(near):
            break
        a, b = nearest_points(x[fine], points, counted), nearest_points(near, points, counted)
        if ((shared(a, b) >= least) & (shared(a[:, :lead], b[:, :lead]) >= 2)).mean() >= least_recall:
            return points, (lead, counted, least)
    return points[:1], (1, 1, 1)


def whole_groups(batches, names: tuple[str, ...]):
    """Arrow tables cut where the named columns of sorted rows change, so that no group is in two of them."""
    rest: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(n).to_numpy() for n in names]
        before = [rest[-1].column(n)[-1].as_py() if rest else None for n in names]
        new = reduce(np.logical_or, [np.append(c[:1] != b, c[1:] != c[:-1]) for c, b in zip(columns, before, strict=True)])
        cut = np.flatnonzero(new)
        if len(cut) and rest and cut[-1] >= 0:
            yield pa.concat_tables([*rest, table.slice(0, cut[-1])]).combine_chunks()
            rest = []
        elif len(cut) and cut[-1]:
            yield table.slice(0, cut[-1])
        rest.append(table.slice(cut[-1] if len(cut) else 0))
    if rest:
        yield pa.concat_tables(rest).combine_chunks()


def _matching(n_points: int, lead: int, least: int, threshold: float | None, tile: int = 1024):
    """For mapInArrow, over rows sorted by group (list, pair of its blocks).

    A pair of a group's entries, one of each block, is a candidate if it shares least reference points and this is the first list that
    both stand in. Without a threshold, the rows of entries with a candidate go on; with one, candidates are verified,
    and what comes out is (u, null, n): linked vectors of u, and (u, v, null): links that join what is linked.
    """

    def run(batches):
        for table in whole_groups(batches, ("g", "label", "list")):
            columns = [table.column(n).to_numpy() for n in ("g", "label", "list")]
            new = reduce(np.logical_or, [np.append(True, c[1:] != c[:-1]) for c in columns])
            starts = np.append(np.flatnonzero(new), len(new))
            several = np.flatnonzero(np.diff(starts) > 1)
            if not len(several):
                continue
            near = _matrix(table, "near")
            own, same, e = (table.column(n).to_numpy() for n in ("own", "same", "e"))
            keep, out = np.zeros(len(new), bool), []
            if threshold is not None:
                x, n = unit(_matrix(table, "x")), table.column("n").to_numpy()
            for k in several.tolist():
                rows = np.arange(starts[k], starts[k + 1])
                low, high = divmod(int(columns[2][starts[k]]), n_points)
                if same[rows[0]]:
                    left = right = rows
                else:
                    sides = own[rows]
                    left, right = rows[sides == sides.min()], rows[sides != sides.min()]
                numbers, places = np.unique(near[rows], return_inverse=True)
                hot = np.zeros((len(rows), len(numbers)), np.float32)
                np.put_along_axis(hot, places.reshape(len(rows), -1), 1, 1)
                first = np.zeros_like(hot)
                np.put_along_axis(first, places.reshape(len(rows), -1)[:, :lead], 1, 1)
                first[:, (numbers >= high) | (numbers == low)] = 0  # a list of smaller numbers would come before
                at = rows[0]
                us, vs = [], []
                for i in range(0, len(left), tile):
                    a = left[i : i + tile]
                    fits = (hot[a - at] @ hot[right - at].T >= least) & (first[a - at] @ first[right - at].T == 0)
                    if same[rows[0]]:
                        fits &= a[:, None] < right[None]
                    if threshold is not None:
                        fits &= x[a] @ x[right].T >= threshold
                    u, v = np.nonzero(fits)
                    us.append(a[u])
                    vs.append(right[v])
                u, v = np.concatenate(us), np.concatenate(vs)
                if not len(u):
                    continue
                if threshold is None:
                    keep[u] = keep[v] = True
                    continue
                size = len(rows)
                count = np.bincount(u - at, n[v], size) + np.bincount(v - at, n[u], size)
                linked = np.flatnonzero(count)
                root = _roots(u - at, v - at, size)
                joined = np.flatnonzero(root != np.arange(size))
                out.append((e[rows[linked]], None, count[linked].astype(np.int64)))
                out.append((e[rows[joined]], e[rows[root[joined]]], None))
            if threshold is None:
                yield from table.select(["g", "label", "list", "own", "same", "e"]).filter(pa.array(keep)).to_batches()
            else:
                for u, v, c in out:
                    nulls = pa.nulls(len(u), pa.int64())
                    columns = [pa.array(u), nulls if v is None else pa.array(v), nulls if c is None else pa.array(c)]
                    yield pa.RecordBatch.from_arrays(columns, ["u", "v", "n"])

    return run


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    """A column of lists of one length."""
    return pa.concat_arrays(table.column(name).chunks).flatten().to_numpy().reshape(table.num_rows, -1)


def _roots(u: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """The smallest number that links (u, v) reach from each of size numbers."""
    root = np.arange(size)
    while True:
        before = root.copy()
        np.minimum.at(root, u, before[v])
        np.minimum.at(root, v, before[u])
        root = root[root]
        if (root == before).all():
            return root


def _lists(near: Column, lead: int, n_points: int) -> Column:
    """The lists of an entry: a number for each pair of its lead nearest points."""
    points = [near[k].cast("long") for k in range(lead)]
    pairs = [F.least(a, b) * n_points + F.greatest(a, b) for i, a in enumerate(points) for b in points[i + 1 :]]
    return F.array(*(pairs or [points[0] * n_points + points[0]]))


def links(entries: DataFrame, d: int, *, threshold: float, sample: int, most_points: int, block: int) -> DataFrame:
    """(u, v, n) of entries (e, label, x, n: all vectors of length d), as a written table: see _matching()."""
    spark = entries.sparkSession
    drawn = entries.orderBy(F.xxhash64("x"), "x").limit(sample).select("x").collect()
    points, (lead, counted, least) = fit(unit(np.array([r.x for r in drawn], float).reshape(-1, d)), threshold, most_points=most_points)
    held = spark.sparkContext.broadcast(points)  # most_points at most

    def described(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                own = batch.slice(i, 2048)
                near = nearest_points(unit(own.column(2).flatten().to_numpy().reshape(-1, d)), held.value, counted).astype(np.int16)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), counted).cast(pa.list_(pa.int16()))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), lists], ["e", "label", "near"])

    near = common.written(entries.select("e", "label", "x").mapInArrow(described, "e long, label long, near array<short>"), "pivot-lists")
    n_points = len(points)
    rows = near.withColumn("list", F.explode(_lists(F.col("near"), lead, n_points)))
    large = rows.groupBy("label", "list").count().filter(F.col("count") > block)
    large = common.small(common.written(large.select("label", "list", F.ceil(F.col("count") / block).alias("blocks")), "pivot-blocks"), 10_000)
    rows = rows.join(large, ["label", "list"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("e"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    group = F.xxhash64("label", "list", F.least("own", "other"), F.greatest("own", "other")).alias("g")
    rows = rows.select(group, "label", "list", "own", (F.col("own") == F.col("other")).alias("same"), "e", "near")
    kinds = "g long, label long, list long, own int, same boolean, e long"
    met = rows.repartition("g").sortWithinPartitions("g", "label", "list").mapInArrow(_matching(n_points, lead, least, None), kinds)
    met = common.written(met, "pivot-candidates").join(entries.select("e", "x", "n"), "e").join(near.select("e", "near"), "e")
    met = met.select("g", "label", "list", "own", "same", "e", "near", "x", "n")
    found = met.repartition("g").sortWithinPartitions("g", "label", "list").mapInArrow(_matching(n_points, lead, least, threshold), "u long, v long, n long")
    return common.written(found, "pivot-links")


def near_duplicates(
    vectors: DataFrame, *, threshold: float = 0.98, sample: int = 4096, most_points: int = 1024, block: int = 2048,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id, kept. Vectors of one label link at a cosine of threshold or more.

    Distinct vectors of a label are entries. Each is described by its nearest reference points: at most most_points vectors of a
    sample of bounded size (the first by a hash), none near another. An inverted list for every pair of points has the entries that
    have both among their nearest; entries that meet there and share enough points are candidates, and the cosine of the
    original vectors, in double precision, decides. How many points are taken is fitted so that 998 of 1000 pairs planted at
    just the threshold are found (see fit()). Lists of over block entries are split, and pairs of blocks spread. First
    only entry numbers and points move; vectors then go where an entry has a candidate. A pair is counted in the first list that
    it shares and never becomes a row: tasks give counts, and links that join what they found.

    n_links counts other rows, so equal vectors of a label, which are one entry, link with each other. component_id is the smallest id
    that links reach; kept is whether it is the row's own. Rows whose label or vector is null, whose vector is zero
    or holds a null or non-finite number, link with nothing. Vectors of different lengths do not link. A null id is no
    component's id unless it has no other, and such rows are kept only then; of rows that share the smallest id all are kept.
    Repeated rows are rows of their own. No rows give no rows. Other columns are not read.
    """
    if not 0 < threshold <= 1 or block < 1 or not 1 <= most_points < 1 << 15:
        raise ValueError("threshold is above 0 and 1 at most, block 1 at least, most_points under 32768")
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v + 0.0)  # -0.0 is 0.0
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), x.alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("fine", F.coalesce(fine & F.col("label").isNotNull(), F.lit(False)))
    own = rows.filter("fine").select("vec_id", "label", "x")
    keys = [F.xxhash64(F.lit(k), "label", "x").alias(f"k{k}") for k in (1, 2)]  # 128 bits of label and vector
    entries = own.groupBy("label", "x").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    entries = entries.select(F.monotonically_increasing_id().alias("e"), "label", "x", "n", "least", F.size("x").alias("d"), *keys)
    entries = common.written(entries, "pivot-entries")
    found = []
    for d in sorted(r.d for r in entries.select("d").distinct().collect()):  # a few lengths
        found.append(links(entries.filter(F.col("d") == d), d, threshold=threshold, sample=sample, most_points=most_points, block=block))
    odd = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found:
        met = reduce(DataFrame.unionByName, found)
        counts = met.filter("v is null").groupBy("u").agg(F.sum("n").alias("linked")).withColumnRenamed("u", "e")
        roots = connected_components(met.filter("v is not null").select("u", "v")).withColumnRenamed("node", "e")
        nodes = entries.select("e", "k1", "k2", "n", "least").join(counts, "e", "left").join(roots, "e", "left")
        nodes = common.written(nodes.select("k1", "k2", "least", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "e").alias("root")), "pivot-nodes")
        least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
        nodes = nodes.join(least, "root").select("k1", "k2", "n_links", "component_id")
        odd = own.select("vec_id", *keys).join(nodes, ["k1", "k2"]).select("vec_id", "n_links", "component_id").unionByName(odd)
    return odd.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
