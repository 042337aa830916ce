"""Approximate nearest neighbours by additive quantisation: a vector is a sum of one word of each codebook."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common


def _nearest_words(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every word."""
    return (x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None]


def _sums(x: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the rows of x by their number in at, counts) for numbers below k."""
    order = np.argsort(at, kind="stable")
    counts = np.bincount(at, minlength=k)
    out = np.zeros((k, x.shape[1]), x.dtype)
    filled = np.flatnonzero(counts)
    out[filled] = np.add.reduceat(x[order], (np.cumsum(counts) - counts)[filled], axis=0)
    return out, counts


def _kmeans(x: np.ndarray, k: int, rounds: int, draw: np.random.Generator) -> np.ndarray:
    words = x[draw.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest_words(x, words).argmin(1)
        sums, counts = _sums(x, nearest, k)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def encode(x: np.ndarray, books: np.ndarray, beam: int = 8) -> np.ndarray:
    """Codes (rows, books) by beam search.

    Book by book, each of a row's beam best partial sums is extended by every word, and the beam best of
    those, by the distance from the row to the sum, are kept.
    """
    n, n_books, n_words = len(x), len(books), books.shape[1]
    out = np.zeros((n, n_books), np.int32)
    for at in range(0, n, 1024):
        rows = x[at : at + 1024].astype(np.float32)
        rest = rows[:, None]  # what each beam's sum leaves of the row
        codes = np.zeros((len(rows), 1, 0), np.int32)
        for book in books:
            flat = _nearest_words(rest.reshape(-1, rest.shape[2]), book.astype(np.float32)).reshape(len(rows), -1)
            width = min(beam, flat.shape[1])
            best = np.argpartition(flat, width - 1, axis=1)[:, :width]
            best = np.take_along_axis(best, np.take_along_axis(flat, best, 1).argsort(1, kind="stable"), 1)
            parent, word = best // n_words, best % n_words
            rest = np.take_along_axis(rest, parent[:, :, None], 1) - book.astype(np.float32)[word]
            codes = np.concatenate([np.take_along_axis(codes, parent[:, :, None], 1), word[:, :, None].astype(np.int32)], 2)
        out[at : at + len(rows)] = codes[:, 0]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(book[codes[:, m]] for m, book in enumerate(books))


def train(x: np.ndarray, n_books: int = 32, n_words: int = 128, *, rounds: int = 6, refits: int = 2, beam: int = 4, seed: int = 11) -> np.ndarray:
    """Codebooks (books, words, dimension). Each starts as k-means of what the books before leave. Then all are refitted
    to the codes that beam search gives: book by book, a word becomes the mean of what the other books leave of its rows."""
    draw = np.random.default_rng(seed)
    n_words = max(1, min(n_words, len(x)))
    rest, books = x.astype(np.float32), []
    for _ in range(n_books):
        books.append(_kmeans(rest, n_words, rounds, draw))
        rest = rest - books[-1][_nearest_words(rest, books[-1]).argmin(1)]
    out = np.stack(books)
    for _ in range(refits):
        codes = encode(x, out, beam)
        rest = x.astype(np.float32) - decode(codes, out)
        for _ in range(3):
            for m, own in enumerate(codes.T):
                rest += out[m][own]
                sums, counts = _sums(rest, own, n_words)
                out[m] = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], out[m])
                rest -= out[m][own]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (id, x: array of double) that take part."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & fine)
    return rows.distinct()


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(e, x, ids): each vector once, with a number, as a written table.

    Equal vectors are one entry with its k + 1 smallest ids: no more of them can be among a query's k nearest, so a vector
    that many rows share costs no more than another.
    """
    order = Window.partitionBy("x").orderBy("id")
    own = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)  # limited before the exchange, too
    entries = own.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return common.written(entries.select(F.monotonically_increasing_id().alias("e"), "x", "ids"), "ann-vectors")


def build_index(entries: DataFrame, d: int, *, n_books: int, n_words: int, sample: int, beam: int) -> tuple[DataFrame, np.ndarray]:
    """The index, as a written table, and the codebooks. A row is a batch of entries: their numbers, codes (a byte for each
    book) and stored squared norms of the coded sums, and no vectors."""
    drawn = entries.orderBy(F.xxhash64("x"), "x").limit(sample).select("x").collect()
    x = np.array([r.x for r in drawn], float).reshape(-1, d)
    books = train(x, n_books, n_words, beam=beam) if len(x) else np.zeros((n_books, 1, d), np.float32)
    shared = entries.sparkSession.sparkContext.broadcast(books)  # of fixed size

    def run(batches):
        for batch in common.small_batches(batches):
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            if len(x):
                codes = encode(x, shared.value, beam)
                norms = (decode(codes, shared.value) ** 2).sum(1)
                columns = (batch.column(0).to_numpy().astype("<i8"), codes.astype(np.uint8), norms.astype("<f4"))
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["entries", "codes", "norms"])

    made = entries.select("e", "x").mapInArrow(run, "entries binary, codes binary, norms binary")
    return common.written(made, "ann-index"), books


def scores(queries: np.ndarray, codes: np.ndarray, norms: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances of queries from coded sums, less the queries' own squared norms, by lookup tables of queries times
    words."""
    n_books, n_words, d = books.shape
    table = (2 * queries.astype(np.float32) @ books.reshape(-1, d).T).reshape(len(queries), n_books, n_words)
    out = np.broadcast_to(norms, (len(queries), len(norms))).copy()
    for m in range(n_books):
        out -= np.take(table[:, m], codes[:, m], axis=1)
    return out


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n smallest of each row."""
    return np.argpartition(values, n - 1, axis=1)[:, :n] if n < values.shape[1] else np.broadcast_to(np.arange(values.shape[1]), values.shape)


def shortlists(asked: DataFrame, index: DataFrame, books: np.ndarray, d: int, *, shortlist: int, queries_at_once: int) -> DataFrame:
    """(query_id, e): the shortlist entries of the whole index that the codes say are nearest to each query.

    Queries in blocks meet the index in parts of it; codes and norms are all that moves of the index. A task keeps a block's
    best entries while it goes through a part, and the best of all parts are taken in Spark.
    """
    spark = asked.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, shared = 2 * n, spark.sparkContext.broadcast(books)

    def packed(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, queries_at_once):
                own = batch.slice(i, queries_at_once)
                columns = (own.column(0).to_numpy().astype("<i8"), own.column(1).flatten().to_numpy().astype("<f4"))
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["ids", "queries"])

    blocks = asked.select("id", "x").mapInArrow(packed, "ids binary, queries binary")
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(n, "part")
    dealt = index.withColumn("part", F.pmod(F.xxhash64("entries"), F.lit(parts)).cast("int")).repartition(n, "part")

    def best(ids: np.ndarray, near: np.ndarray, entries: np.ndarray):
        each = near.shape[1]
        columns = (pa.array(np.repeat(ids, each)), pa.array(entries.ravel()), pa.array(near.ravel().astype(np.float32)))
        return pa.RecordBatch.from_arrays(list(columns), ["query_id", "e", "near"])

    def run(batches):
        key, ids, near, entries = None, None, None, None
        for batch in batches:
            for r in ({name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)} for k in range(batch.num_rows)):
                if r["ids"] != key:
                    if key is not None:
                        yield best(ids, near, entries)
                    key, ids = r["ids"], np.frombuffer(r["ids"], "<i8")
                    near, entries = np.zeros((len(ids), 0), np.float32), np.zeros((len(ids), 0), np.int64)
                queries = np.frombuffer(r["queries"], "<f4").reshape(len(ids), d)
                codes, norms = np.frombuffer(r["codes"], np.uint8).reshape(-1, len(books)), np.frombuffer(r["norms"], "<f4")
                own = np.frombuffer(r["entries"], "<i8")
                found, numbers = [], []
                for i in range(0, len(ids), 128):  # bounds the table of scores
                    s = scores(queries[i : i + 128], codes, norms, shared.value)
                    at = _smallest(s, shortlist)
                    found.append(np.take_along_axis(s, at, 1))
                    numbers.append(own[at])
                near = np.concatenate([near, np.concatenate(found)], 1)
                entries = np.concatenate([entries, np.concatenate(numbers)], 1)
                at = _smallest(near, shortlist)
                near, entries = np.take_along_axis(near, at, 1), np.take_along_axis(entries, at, 1)
        if key is not None:
            yield best(ids, near, entries)

    met = blocks.join(dealt.hint("merge"), "part").select("ids", "queries", "entries", "codes", "norms")
    found = met.mapInArrow(run, "query_id long, e long, near float")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("near", "e"))
    return found.withColumn("n", rank).filter(F.col("n") <= shortlist).select("query_id", "e")


def nearest(
    vectors: DataFrame, *, k: int = 10, every: int = 100, n_books: int = 32, n_words: int = 128, sample: int = 8192, beam: int = 4,
    shortlist: int = 256, queries_at_once: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by every; candidates all rows but those with the query's
    id. Every distinct vector is coded as a sum of one word of each of n_books codebooks (at most 256 words each), which are
    trained on the driver from at most sample distinct vectors, first by a hash. Lookup tables score all codes for all
    queries, by blocks; the shortlist best of each query, of the whole index, are then fetched by number and measured. score
    is the Euclidean distance of the original vectors, in double precision; ties go to the smaller id.

    Vectors are compared with those of their own length only: each length is an index of its own. Rows that are null, zero,
    hold a null or non-finite number, or have no id, take no part. Rows alike in id and vector count once. A query id with
    several vectors of a length uses the smallest of them. No rows, or no other row, gives no rows. every and k are 1 at
    least (less raises ValueError). Other columns are not read.
    """
    if every < 1 or k < 1 or not 1 <= n_words <= 256:
        raise ValueError("every and k are 1 at least, n_words 1 to 256")
    spark = vectors.sparkSession
    rows = common.written(usable(vectors, id_col, vector_col).withColumn("d", F.size("x")), "ann-rows")
    found = []
    for d in sorted(r.d for r in rows.select("d").distinct().collect()):  # a few lengths
        found.append(_nearest(rows.filter(F.col("d") == d).drop("d"), d, k, every, n_books, n_words, sample, beam, max(shortlist, 2 * k + 2), queries_at_once))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, d: int, k: int, every: int, n_books: int, n_words: int, sample: int, beam: int, shortlist: int, at_once: int) -> DataFrame:
    entries = distinct_vectors(rows, k)
    index, books = build_index(entries, d, n_books=n_books, n_words=n_words, sample=sample, beam=beam)
    asked = common.written(rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("x").alias("x")), "ann-queries")
    short = shortlists(asked, index, books, d, shortlist=shortlist, queries_at_once=at_once)
    met = short.join(entries, "e").join(asked.select(F.col("id").alias("query_id"), F.col("x").alias("q")), "query_id")
    square = F.aggregate(F.zip_with("x", "q", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda sum_, v: sum_ + v)
    met = met.select("query_id", F.sqrt(square).alias("score"), F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
