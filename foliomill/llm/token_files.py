"""Token-id files: one independent Zstandard frame for each document and a trailing seek table.

Layout of a file: the frames, in ascending document order; a skippable frame with the sorted document
ids; a skippable frame with the seek table (compressed size, raw size and checksum of each frame), in
the public seekable format, whose footer is the end of the file. A reader loads the two tables and then
decompresses the frames of the documents that it is asked for, and no others. A frame's content is
its document's ids as little-endian unsigned 32-bit integers; the checksum is the low half of XXH64.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import common
from foliomill.sinks import paths

#: Fixed values of the seekable Zstandard format: skippable frames, the table's footer.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80


class CorruptFrame(ValueError):
    """A frame's content does not have the checksum that the seek table names."""


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents in ascending order of id (null first) to one file."""

    def __init__(self, out, level: int = 1):
        self.out, self.zstd = out, zstandard.ZstdCompressor(level=level)
        self.table, self.doc_ids, self.nulls = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if len(ids) >= 1 << 32:
            raise ValueError("a frame holds less than 4 GiB of ids")
        frame = self.zstd.compress(ids)
        self.out.write(frame)
        self.table.append((len(frame), len(ids), _checksum(ids)))
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        index = struct.pack("<Q", self.nulls) + np.array(self.doc_ids, "<i8").tobytes()
        index = zstandard.ZstdCompressor(level=1).compress(index)
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        table = np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)


class TokenFileReader:
    """Reads documents of one file; source is a seekable binary file."""

    def __init__(self, source):
        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        source.seek(0, 2)
        end = source.tell()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise CorruptFrame("no seek table with checksums")
        self.table = np.frombuffer(self._at(end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        size = struct.unpack("<II", self._at(int(self.starts[-1]), 8))[1]
        index = self.zstd.decompress(self._at(int(self.starts[-1]) + 8, size))
        self.nulls = struct.unpack_from("<Q", index)[0]
        self.doc_ids = np.frombuffer(index, "<i8", offset=8)

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def doc_id(self, k: int) -> int | None:
        return None if k < self.nulls else int(self.doc_ids[k - self.nulls])

    def frame(self, k: int) -> bytes:
        """The ids of the k-th document of the file."""
        size, raw_size, checksum = (int(x) for x in self.table[k])
        raw = self.zstd.decompress(self._at(int(self.starts[k]), size), max_output_size=max(1, raw_size))
        if len(raw) != raw_size or _checksum(raw) != checksum:
            raise CorruptFrame(f"frame {k}")
        return raw

    def frames_of(self, doc_ids: Iterable[int] | None) -> Iterator[int]:
        """Positions of the frames of doc_ids (None: of all), found by binary search."""
        if doc_ids is None:
            yield from range(len(self.table))
            return
        for x in sorted(set(doc_ids)):
            a, b = np.searchsorted(self.doc_ids, [x, x + 1])
            yield from range(self.nulls + int(a), self.nulls + int(b))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int, files: int | None = None, file_bytes: int = 256 << 20,
    id_col: str = "doc_id", text_col: str = "text", level: int = 1,
) -> DataFrame:
    """Encode every whole text, append end_id, and write the files in ascending order of document id.

    One exchange by ranges of (id, text hash, place in the input) makes as many files as there are shuffle partitions, more
    where a file would hold over file_bytes of text (or files, if given). So rows that share one id, and rows that are
    alike, are spread too. Each task writes a file under a name of its attempt; the returned table names those of the
    attempts that succeeded. Returns: part (files in ascending order), path, n_docs, n_tokens, start (ids in all files before).

    folder is named as Spark names it; without a scheme it is on Spark's default file system. Null texts are empty and
    have the end id alone. A text of 4 GiB of ids and more does not fit a frame and raises ValueError; below that texts
    are held one batch at a time. Documents without id come first. Ties, and repeated rows, are all kept, side by side.
    An empty table gives no files. Columns other than the two are not read.
    """
    spark = docs.sparkSession
    folder = paths.qualified(spark, folder)
    system, base = paths.opened(folder)
    system.create_dir(base, recursive=True)
    if files is None:
        files = common.parts_for(spark, docs.agg(F.sum(common.text_size(text_col))).first()[0] or 0, file_bytes)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        files_system, base = paths.opened(folder)
        context = TaskContext.get()
        path, writer, n_docs, n_tokens = "", None, 0, 0
        encode = common.encoder(tokenizer).encode
        for batch in common.small_batches(batches):
            if writer is None:
                name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.tokens"
                path = f"{base}/{name}"
                writer = TokenFileWriter(files_system.open_output_stream(path, compression=None), level)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                writer.add(doc_id, ids + end)
                n_docs += 1
                n_tokens += len(ids) // 4 + 1
        if writer is not None:
            writer.close()
            writer.out.close()
            row = [[context.partitionId()], [f"{folder}/{name}"], [n_docs], [n_tokens]]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(x, kind) for x, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "path", "n_docs", "n_tokens"])

    rows = common.placed(docs, "_place").select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), "_place")
    order = [F.asc_nulls_first("id"), F.xxhash64("text"), F.col("_place")]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    made = rows.mapInArrow(write, "part long, path string, n_docs long, n_tokens long")
    made = common.written(made, "token-files")  # fixes which attempts' files count
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file only
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of the files that write_token_files() returned, each checked against its checksum.

    doc_ids: only these; other frames are not decompressed. Returns doc_id, start (ids of all documents
    before it), n_tokens, ids (little-endian unsigned 32-bit).
    """

    def read(batches):
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                files_system, at = paths.opened(path)
                with files_system.open_input_file(at) as source:
                    reader = TokenFileReader(source)
                    before = start + np.concatenate([[0], np.cumsum(reader.table[:, 1] // 4, dtype=np.int64)])
                    rows, size = [], 0
                    for k in reader.frames_of(doc_ids):
                        ids = reader.frame(k)
                        rows.append((reader.doc_id(k), int(before[k]), len(ids) // 4, ids))
                        size += len(ids)
                        if size > 8 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    spread = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = files.select("path", "start").repartition(spread)
    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    columns = zip(zip(*rows, strict=True), kinds.values(), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], list(kinds))
