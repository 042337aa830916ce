"""Ranked lexical search over a bit-sliced impact index: bitmaps of the bits of each term's impacts, added with carries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common

#: What becomes of each byte of a text: letters in lower case, digits and bytes of other signs as they are, all else a space.
BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of texts (null: none), one after the other, and the number of the text of each."""
    texts = pc.cast(texts, pa.large_string())
    _, offsets, data = texts.buffers()
    if data is None:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low = pa.py_buffer(data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(BYTES))
    low = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(ends - ends[0])), low])
    words = pc.ascii_split_whitespace(pc.if_else(texts.is_null(), "", low))
    flat = words.flatten()
    at = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    filled = pc.not_equal(flat, "")  # white space at an end leaves an empty one
    return flat.filter(filled), at[filled.to_numpy(zero_copy_only=False)]


def _distinct(dictionaries: list[pa.Array], codes: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """One dictionary for several, and all codes in it."""
    each = pc.dictionary_encode(pa.concat_arrays(dictionaries))
    new, at, out = each.indices.to_numpy(zero_copy_only=False), 0, []
    for d, c in zip(dictionaries, codes, strict=True):
        out.append(new[at : at + len(d)][c])
        at += len(d)
    return each.dictionary, np.concatenate(out)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of values as binaries, the i-th from starts[i] to starts[i + 1]."""
    offsets = (starts * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


class Block:
    """Documents of a block, added a batch at a time."""

    def __init__(self):
        self.ids, self.dictionaries, self.codes, self.places, self.size = [], [], [], [], 0

    def add(self, ids: list, texts: pa.Array) -> None:
        found, at = terms(texts)
        each = pc.dictionary_encode(found)
        self.dictionaries.append(each.dictionary)
        self.codes.append(each.indices.to_numpy(zero_copy_only=False).astype(np.int32))
        self.places.append((at + len(self.ids)).astype(np.int32))
        self.ids += ids
        self.size += texts.nbytes

    def tables(self, number: int, rows: int = 5000):
        """The block's own row, without a term: ids and totals; then a row for each term: places in the order of ids, occurrences
        there, and lengths of these documents."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids = pa.array([self.ids[i] for i in order], pa.int64())
        words, codes = _distinct(self.dictionaries, self.codes)
        places = rank[np.concatenate(self.places)]
        lengths = np.bincount(places, minlength=len(order))
        key, times = np.unique(codes.astype(np.int64) * len(order) + places, return_counts=True)
        term, place = key // len(order), key % len(order)
        starts = np.append(np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else [], len(term)).astype(np.int64)
        head = [[number], [None], [len(order)], [None], [None], [None], pa.array([ids], pa.list_(pa.int64())), [int((lengths > 0).sum())], [int(lengths.sum())]]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if isinstance(x, list) else x for x, f in zip(head, POSTINGS, strict=True)], schema=POSTINGS)
        columns = [_lists(place.astype("<u2"), starts), _lists(times.astype("<u4"), starts), _lists(lengths[place].astype("<u4"), starts)]
        names, sizes = words.take(pa.array(term[starts[:-1]])), np.diff(starts)
        for i in range(0, len(sizes), rows):
            n = min(rows, len(sizes) - i)
            own = [pa.array([number] * n), names.slice(i, n), pa.array(sizes[i : i + n]), *(c.slice(i, n) for c in columns), *(pa.nulls(n, POSTINGS.field(k).type) for k in (6, 7, 8))]
            yield pa.RecordBatch.from_arrays([pc.cast(x, f.type) for x, f in zip(own, POSTINGS, strict=True)], schema=POSTINGS)


POSTINGS = pa.schema([
    ("block", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("places", pa.binary()), ("times", pa.binary()), ("lengths", pa.binary()),
    ("ids", pa.list_(pa.int64())), ("filled", pa.int64()), ("total", pa.int64()),
])
_KINDS = "block long, term string, df long, places binary, times binary, lengths binary, ids array<long>, filled long, total long"


def postings(docs: DataFrame, id_col: str, text_col: str, block_docs: int, block_bytes: int) -> DataFrame:
    """A written table of blocks of documents, inverted: see Block.tables(). Documents are taken where they stand, without an exchange."""

    def run(batches):
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in common.small_batches(batches, block_bytes // 2):
            for i in range(0, batch.num_rows, block_docs):
                own = batch.slice(i, block_docs)
                if block.ids and (len(block.ids) + own.num_rows > block_docs or block.size + own.nbytes > block_bytes):
                    yield from block.tables(number)
                    number, block = number + 1, Block()
                block.add(own.column(0).to_pylist(), own.column(1))
        if block.ids:
            yield from block.tables(number)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.written(rows.mapInArrow(run, _KINDS), "impact-postings")


def sliced(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts of them) of the bits of runs of values: byte [k, s] of a run has bit s of its values 8k to 8k + 7."""
    n_slices = max(1, int(values.max(initial=0)).bit_length())
    sizes = np.diff(starts)
    n_bytes = -(-sizes // 8)
    at = np.append(0, np.cumsum(n_bytes))
    inside = np.arange(len(values)) - np.repeat(starts[:-1], sizes)
    first = np.flatnonzero(inside % 8 == 0)
    shift = (7 - inside % 8).astype(np.uint8)
    out = np.zeros((at[-1], n_slices), np.uint8)
    for s in range(n_slices):
        bits = ((values >> s) & 1).astype(np.uint8) << shift
        out[:, s] = np.add.reduceat(bits, first) if len(first) else bits
    return out, at


@dataclass(frozen=True)
class Index:
    """impacts (term, block, slices, places, bits): a row for each term of each block; blocks (block, ids)."""

    impacts: DataFrame
    blocks: DataFrame


def build(docs: DataFrame, *, block_docs: int = 16384, block_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all terms of all documents, as written tables. A term's row in a block has, for each bit of its impacts, a bitmap over
    the documents that hold it there.

    A document is in one block, of block_docs documents and about block_bytes at most (a longer text is a block of its own). Only inverted blocks
    move, once, to meet the weights of their terms; a common term has one bounded row for each block, and a partition of many
    of them can be split.
    """
    if not 0 < block_docs <= 1 << 16:
        raise ValueError("block_docs is 1 to 65536")
    rows = postings(docs, id_col, text_col, block_docs, block_bytes)
    sums = rows.agg(F.sum("filled").alias("n"), F.sum("total").alias("l")).first()
    n, l = sums.n or 0, sums.l or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = rows.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("w"))
    met = rows.filter("term is not null").select("term", "block", "places", "times", "lengths").hint("merge").join(weights, "term")

    def run(batches):
        for batch in common.small_batches(batches, 4 << 20):
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            flat = lambda c: np.frombuffer(b"".join(column[c].to_pylist()), "<u4").astype(np.int64)
            sizes = pc.binary_length(column["places"]).to_numpy() // 2
            starts = np.append(0, np.cumsum(sizes))
            times, lengths, w = flat("times"), flat("lengths"), np.repeat(column["w"].to_numpy(), sizes)
            m = 25 + 75 * lengths * n // l
            bits, at = sliced(w * (1_000_000_000 * times // (1000 * times + 8 * m)), starts)
            data = pc.cast(_lists(bits.reshape(-1), at * bits.shape[1]), pa.binary())
            slices = pa.array([bits.shape[1]] * len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays([column["term"], column["block"], slices, column["places"], data], ["term", "block", "slices", "places", "bits"])

    impacts = met.mapInArrow(run, "term string, block long, slices int, places binary, bits binary")
    return Index(common.written(impacts, "impact-index"), rows.filter("term is null").select("block", "ids"))


def expanded(places: bytes, bits: bytes, n_slices: int, n_words: int) -> np.ndarray:
    """Bitmaps [slice, word] over a block's documents of a term's row."""
    at = np.frombuffer(places, "<u2")
    own = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(-1, n_slices), axis=0)[: len(at)]
    out = np.zeros((n_slices, n_words * 64), np.uint8)
    out[:, at] = own.T
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def add(sums: np.ndarray, rows: np.ndarray, bitmaps: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Adds bitmaps [slice, word], as numbers, times over to rows of sums [slice, row, word], by half and full adders; sums with as many
    slices as it takes."""
    for shift in range(int(times.max()).bit_length()):
        own = rows[(times >> shift) & 1 == 1]
        if not len(own):
            continue
        own = slice(own[0], own[0] + 1) if len(own) == 1 else own
        carry, s = np.zeros_like(sums[0, own]), shift
        for bits in bitmaps:
            if s == len(sums):
                sums = np.concatenate([sums, np.zeros_like(sums[:8])])
            a = sums[s, own]
            x = a ^ bits
            both = (a & bits) | (x & carry)
            sums[s, own] = x ^ carry
            carry, s = both, s + 1
        while carry.any():
            if s == len(sums):
                sums = np.concatenate([sums, np.zeros_like(sums[:8])])
            a = sums[s, own]
            both = a & carry
            sums[s, own] = a ^ carry
            carry, s = both, s + 1
    return sums


def top(sums: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row of sums [slice, row, word], the places of the k greatest numbers above 0 (all, if fewer), smaller places first among
    equal ones, in no order.

    From the most significant slice down, sure has places that are surely among them and open those that tie so far.
    """
    open_ = np.bitwise_or.reduce(sums, axis=0)
    sure = np.zeros_like(open_)
    for bits in sums[::-1]:
        with_bit = sure | (open_ & bits)
        many = (np.bitwise_count(with_bit).sum(1) > k)[:, None]
        open_ = np.where(many, open_ & bits, open_ & ~bits)
        sure = np.where(many, sure, with_bit)
    out = []
    for a, b in zip(sure, open_, strict=True):
        taken = np.flatnonzero(np.unpackbits(a.view(np.uint8), bitorder="little"))
        ties = np.flatnonzero(np.unpackbits(b.view(np.uint8), bitorder="little")) if len(taken) < k else taken[:0]
        out.append(np.append(taken, ties[: k - len(taken)]))
    return out


def _ranking(k: int):
    """For mapInArrow, over rows sorted by (queries, block), the block's own first: the k best of the block for each query."""

    def best(block, ids, known, sums):
        rows = list(known)
        scores, places, owners = [], [], []
        for row, found in zip(rows, top(sums[:, : len(rows)], k), strict=True):
            words, bit = found >> 6, (found & 63).astype(np.uint64)
            own = (sums[:, known[row]][:, words] >> bit) & np.uint64(1)
            scores.append((own.astype(np.int64) << np.arange(len(own))[:, None]).sum(0))
            places.append(found)
            owners += [row] * len(found)
        place = np.concatenate(places)
        columns = [pa.array(owners, pa.int64()), pa.array([block] * len(place), pa.int64()), pa.array(place, pa.int64()), ids.take(pa.array(place)), pa.array(np.concatenate(scores))]
        return pa.RecordBatch.from_arrays(columns, ["q", "block", "place", "doc_id", "score"])

    def run(batches):
        key, block, ids, known, sums = None, None, None, {}, None
        for batch in batches:
            names = {name: i for i, name in enumerate(batch.schema.names)}
            for j in range(batch.num_rows):
                at = lambda name: batch.column(names[name])[j]  # noqa: B023, E731
                if at("term").as_py() is None:
                    if known:
                        yield best(block, ids, known, sums)
                    key, block, ids, known = (at("queries").as_py(), at("block").as_py()), at("block").as_py(), at("ids").values, {}
                    sums = np.zeros((40, 8, -(-len(ids) // 64)), np.uint64)
                    continue
                assert key == (at("queries").as_py(), at("block").as_py()), "a block without its own row"
                asked = at("asked").as_py()
                rows = np.array([known.setdefault(x["q"], len(known)) for x in asked])
                while len(known) > sums.shape[1]:
                    sums = np.concatenate([sums, np.zeros_like(sums)], 1)
                bitmaps = expanded(at("places").as_py(), at("bits").as_py(), at("slices").as_py(), sums.shape[2])
                sums = add(sums, rows, bitmaps, np.array([x["times"] for x in asked]))
        if known:
            yield best(block, ids, known, sums)

    return run


def _asked(queries: DataFrame) -> DataFrame:
    """(q, term, times) of queries (q, text)."""

    def run(batches):
        for batch in common.small_batches(batches):
            found, at = terms(batch.column(1))
            each = pc.dictionary_encode(found)
            key, times = np.unique(at * max(1, len(each.dictionary)) + each.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, code = np.divmod(key, max(1, len(each.dictionary)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pc.cast(each.dictionary.take(pa.array(code)), pa.string()), pa.array(times)], ["q", "term", "times"])

    return queries.select("q", "text").mapInArrow(run, "q long, term string, times long")


def search(
    index: Index, items: DataFrame, *, k: int = 10, at_once: int = 256, most_small: int = 200_000, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """A row for each of the k best documents of each row of items: its item_id, rank, doc_id, score; see ranked().

    Up to most_small terms of items, counted once an item, are broadcast, and the index stays where it is; more meet it by term.
    """
    if k < 1 or at_once < 1:
        raise ValueError("k and at_once are 1 at least")
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = common.written(rows.withColumn("q", F.monotonically_increasing_id()), "impact-items")
    groups = -(-rows.count() // at_once)
    if not groups:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    asked = common.written(_asked(rows), "impact-asked")
    few = asked.count() <= most_small
    asked = asked.withColumn("queries", F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int"))
    asked = asked.groupBy("queries", "term").agg(F.collect_list(F.struct("q", "times")).alias("asked"))  # a group's queries, one row each at most
    impacts = index.impacts.join(F.broadcast(asked), "term") if few else index.impacts.hint("merge").join(asked, "term")
    met = impacts.select("queries", "block", "term", "slices", "places", "bits", "asked", F.lit(None).cast("array<long>").alias("ids"))
    own = index.blocks.withColumn("queries", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    own = own.select("queries", "block", *[F.lit(None).cast(t).alias(c) for c, t in met.dtypes if c not in ("queries", "block", "ids")], "ids")
    dealt = met.select(own.columns).unionByName(own).repartition("queries", "block").sortWithinPartitions("queries", "block", F.col("term").asc_nulls_first())
    found = dealt.mapInArrow(_ranking(k), "q long, block long, place long, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "block", "place")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.join(rows.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, *, k: int = 10, block_docs: int = 16384, block_bytes: int = 32 << 20, at_once: int = 256, most_small: int = 200_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The k documents of the highest score for each item, over an index of all documents: item_id, rank, doc_id, score.

    Scores are sums of whole numbers, the impacts of an item's terms, repeats included. The index holds an impact's bits as
    bitmaps over a block's documents. A block's bitmaps are added to all sums of at_once queries by bitwise carries, a term at a time; the
    k greatest are found from the most significant slice down, and the best of all blocks are taken in Spark. All is exact.

    Equal scores go by doc_id, nulls last. Documents alike in id and text are documents of their own, as are items. Null and empty
    texts have no terms: such documents are not found and do not count, such items have no rows. Long texts are taken whole. No
    documents or no items give no rows. Other columns are not read.
    """
    index = build(docs, block_docs=block_docs, block_bytes=block_bytes, id_col=id_col, text_col=text_col)
    return search(index, items, k=k, at_once=at_once, most_small=most_small, id_col=item_col, text_col=item_text_col)
