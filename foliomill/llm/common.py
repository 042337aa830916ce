"""What several operators of this subpackage share: the shared folder, written intermediates, tokenizers."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.sinks.paths import LOCAL_FOLDER, shared_folder, written  # noqa: F401  the other modules take them from here


def in_written_order(df: DataFrame) -> DataFrame:
    """The rows of df, a table read from Parquet part files, in partitions and rows in the order they were written.

    Spark's scan takes files by their lengths, so its partitions are in no order. Rows that are not read from files have
    no place in one and stay as they are. This shuffles the rows once.
    """
    name, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    number = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long")  # names are of five digits or more
    try:
        placed = df.withColumns({"_number": number, "_name": name, "_place": place})
    except AnalysisException:
        return df
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    placed = placed.repartitionByRange(n, "_number", "_name", "_place")
    return placed.sortWithinPartitions("_number", "_name", "_place").drop("_number", "_name", "_place")


def placed(df: DataFrame, name: str) -> DataFrame:
    """df with a column (long) that tells rows apart which are alike, and is the same each time df is computed.

    It is a hash of file and row index. Rows that are not read from Parquet files have no such place and are written first.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    try:
        return df.withColumn(name, place)
    except AnalysisException:
        return written(df, "placed").withColumn(name, place)


def small(table: DataFrame, most_rows: int) -> DataFrame:
    """A written table, to be broadcast if it has most_rows or fewer."""
    return F.broadcast(table) if table.count() <= most_rows else table


def parts_for(spark: SparkSession, n_bytes: int, part_bytes: int) -> int:
    """Partitions for n_bytes: the session's number of shuffle partitions, and more where a part would exceed part_bytes."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // part_bytes))


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1, so that empty documents count too."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


class Remembered:
    """Ids of words, as bytes. What comes once in a run of texts is not kept; all is forgotten when it grows beyond most."""

    def __init__(self, most: int):
        self.most, self.known = most, {}

    def ids(self, words: list[str], counts: np.ndarray, learn) -> list[bytes]:
        """The ids of distinct words that come counts times; learn gives those of a list of words."""
        found = list(map(self.known.get, words))
        absent = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(absent, learn([words[i] for i in absent]), strict=True):
            found[i] = x
        if len(self.known) > self.most:
            self.known, absent = {}, range(len(words))
        often = (counts > 1).tolist()
        self.known.update((words[i], found[i]) for i in absent if often[i])
        return found


class Encoder:
    """Encodes texts with a tokenizer file of the tokenizers library, as little-endian 32-bit ids.

    A tokenizer that drops white space and never joins what stands on both sides of it gives a text
    the ids of its words, one after the other. For those (told by probing, and by comparing a worker's first texts with
    encoding them whole), each word is encoded once and then looked up; any other tokenizer encodes each text as it is.
    """

    #: A run of letters that normalisation leaves alone and that is one pre-token, then other signs.
    LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?#$%&*"

    def __init__(self, path: str, cached_words: int = 200_000, compared: int = 1 << 18):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.compared = Tokenizer.from_file(path), compared  # compared: signs of texts that are yet to be encoded both ways
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        probes = ("Ab", "c,", "ét", "don't", "x1", "́e", "!?")
        self.by_word = ids("  " + " \n\t".join(probes) + " ") == [i for p in probes for i in ids(p)]
        letters = [c for c in map(chr, range(0x41, 0x100)) if re.match(f"[{self.LETTERS}]", c)]
        self.letters = "".join(letters)
        pieces = lambda text: [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        whole = lambda text: len(pieces(text)) == 1
        self.plain = self.by_word and self.tokenizer.pre_tokenizer is not None and all(
            len(pieces(f"ab{sign}")) == 2 and ids(f"ab{sign}") == ids("ab") + ids(sign) for sign in self.SIGNS
        ) and all(whole(f"a{c}b") and ids(f"{c}.") == ids(c) + ids(".") for c in letters)
        self.folds = all(ids(t) == ids(t.lower()) for c in letters for t in (c, f"a{c}b"))
        self.words, self.stems = Remembered(cached_words), Remembered(cached_words // 2)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # of the last id of a pre-token
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null gives none."""
        if self.by_word and self.compared > 0:
            some = [t for t in texts if t and len(t) <= self.compared][:50]
            self.compared -= sum(map(len, some))
            self.by_word = self._whole(some) == self._words(some)
        return self._words(texts) if self.by_word else self._whole(texts)

    def _whole(self, texts: list[str | None]) -> list[bytes]:
        found = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _words(self, texts: list[str | None], at_once: int = 4 << 20) -> list[bytes]:
        out, part, size = [], [], 0
        for t in texts:
            part.append(t)
            size += len(t) if t else 0
            if size >= at_once:
                out += self._looked_up(part)
                part, size = [], 0
        return out + self._looked_up(part)

    def _looked_up(self, texts: list[str | None]) -> list[bytes]:
        """The ids of the words of each text, one after the other. A word that comes often is looked up once."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words, at = self._distinct(lists.flatten())
        found = self.words.ids(words, np.bincount(at, minlength=len(words)), self._learned)
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        small = np.int32 if max(ends[-1], len(flat)) < 1 << 31 else np.int64
        shift = ((np.cumsum(sizes) - sizes)[at] - ends[:-1]).astype(small)
        ids = flat[np.repeat(shift, n) + np.arange(ends[-1], dtype=small)].tobytes()
        cuts = (4 * ends[lists.offsets.to_numpy()]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905

    @staticmethod
    def _distinct(texts) -> tuple[list[str], np.ndarray]:
        each = pc.dictionary_encode(texts)
        return each.dictionary.to_pylist(), each.indices.to_numpy(zero_copy_only=False)

    def _learned(self, words: list[str]) -> list[bytes]:
        """The ids of words. Letters with signs behind them are two pre-tokens, and the letters are looked up once."""
        rows = pa.array(words, pa.large_string())
        plain = pc.match_substring_regex(rows, f"^[{self.LETTERS}]+[{self.SIGNS}]*$") if self.plain else pa.array([False] * len(words))
        own, other = rows.filter(plain), rows.filter(pc.invert(plain)).to_pylist()
        stems = pc.utf8_rtrim(own, self.SIGNS)
        names, at = self._distinct(pc.utf8_lower(stems) if self.folds else stems)
        ends, behind = self._distinct(pc.utf8_ltrim(own, self.letters))
        stem = self.stems.ids(names, np.bincount(at, minlength=len(names)), self._pieces)
        sign = dict(zip(filled := [x for x in ends if x], self._pieces(filled), strict=True)) | {"": b""}
        sign = [sign[x] for x in ends]
        found = iter([stem[i] + sign[j] for i, j in zip(at.tolist(), behind.tolist(), strict=True)])
        rest = iter([x for i in range(0, len(other), 1000) for x in self._whole(other[i : i + 1000])])
        return [next(found if x else rest) for x in plain.to_pylist()]

    def _pieces(self, pretokens: list[str], at_once: int = 100) -> list[bytes]:
        """The ids of each pre-token. Many are encoded as one text; a last id tells where each ends."""
        out = []
        for i in range(0, len(pretokens), 20 * at_once):
            parts = [pretokens[j : j + at_once] for j in range(i, min(i + 20 * at_once, len(pretokens)), at_once)]
            found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)  # without offsets
            for part, x in zip(parts, found, strict=True):
                ids = np.array(x.ids, "<u4")
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) == len(part):
                    flat, cuts = ids.tobytes(), (cuts * 4).tolist()
                    out += [flat[a:b] for a, b in zip([0, *cuts], cuts)]  # noqa: B905
                else:
                    out += self._whole(part)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a worker process, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def small_batches(batches, most_bytes: int = 16 << 20):
    """Arrow record batches cut so that a run of long texts never stands in memory at once."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)
