"""Token files and packing against encoding whole texts, and an exact round trip."""

import functools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from foliomill.llm import common, packing, token_files
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (3, "Hello, world! It's 2024; café naïve."), (1, None), (2, ""), (7, "a b c <|endoftext|> x"), (5, "word " * 9000),
    (5, "word " * 9000), (None, "no id"), (9, "é ́ 가 don't DON'T İstanbul ﬁn"), (4, " \n\t "), (8, "你好 \U0001f600\U0001f600 ab‍cd"),
]
SCHEMA = "doc_id long, text string, start string, ids int"


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


@functools.cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_whole_texts(spark):
    texts = [t for _, t in TEXTS] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    t = Tokenizer.from_file(PATH)
    got = common.Encoder(PATH, cached_words=50).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_of_tokenizer_with_white_space():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    e = common.Encoder(path)
    assert not e.by_word
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(["a  b c", None])] == [t.encode("a  b c").ids, []]


CASED = ["Cat cat Ab", "Cat, ab! Über über É é", "x1 AB aB don't", "cat.Cat", "", None, "CAT ß İ ab;cat", "a\u00a0b cat"]


def made(kind, path):
    """Tokenizers from given vocabularies: by words of either case, by word pieces, by bytes."""
    from tokenizers import models, normalizers, pre_tokenizers

    pieces = ["[UNK]", "cat", "Cat", "ab", "Ab", "a", "b", "x", "1", ",", "!", ".", ";", "don", "t", "'", "é", "É", "über", "Über", "e", "c", "C"]
    vocabulary = {w: i for i, w in enumerate([*pieces, *(f"##{p}" for p in pieces if p.isalnum())])}
    if kind == "bytes":
        t = Tokenizer(models.BPE({c: i for i, c in enumerate(pre_tokenizers.ByteLevel.alphabet())}, []))
        t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    elif kind == "spaces":
        t = Tokenizer(models.WordLevel(vocabulary | {"cat.Cat": 900, "Cat,": 901, "ab!": 902}, unk_token="[UNK]"))
        t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    else:
        t = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]") if "pieces" in kind else models.WordLevel(vocabulary, unk_token="[UNK]"))
        t.pre_tokenizer = pre_tokenizers.BertPreTokenizer() if "pieces" in kind else pre_tokenizers.Whitespace()
        t.normalizer = normalizers.BertNormalizer(lowercase=True) if "folded" in kind else None
    t.save(path)
    return t


@pytest.mark.parametrize("kind", ["words", "words folded", "pieces", "pieces folded", "spaces", "bytes"])
@pytest.mark.parametrize("compared", [0, 1000])
def test_encoder_of_other_tokenizers(tmp_path, kind, compared):
    t = made(kind, f"{tmp_path}/t.json")
    got = common.Encoder(f"{tmp_path}/t.json", compared=compared).encode(CASED)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [t.encode(x or "", add_special_tokens=False).ids for x in CASED]


def test_encoder_gives_up_words_that_differ_from_whole_texts(monkeypatch):
    e = common.Encoder(PATH)
    monkeypatch.setattr(e, "_words", lambda texts: [b""] * len(texts))
    assert np.frombuffer(e.encode(["Hello there"])[0], "<u4").tolist() == plain("Hello there") and not e.by_word


def test_shared_folder_of_a_cluster(spark):
    class Context:
        def __init__(self, master, folder):
            self.master, self.folder = master, folder
            self.sparkContext = self

        def getConf(self):
            return {"spark.checkpoint.dir": self.folder} if self.folder else {}

    assert common.shared_folder(Context("yarn", "hdfs:///c/"), "x").startswith("hdfs:///c/x-")
    assert common.shared_folder(Context("local[4]", None), "x").startswith(common.LOCAL_FOLDER)
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://h:7077"):
        with pytest.raises(ValueError):
            common.shared_folder(Context(master, None), "x")


def test_round_trip_and_starts(spark, tmp_path):
    files = token_files.write_token_files(docs(spark), str(tmp_path / "t"), PATH, end_id=1, files=3)
    rows = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8, 9]
    by_id, at = dict(TEXTS), 0
    for r in rows:
        ids = [*plain(by_id[r.doc_id]), 1]
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)
    some = token_files.read_token_files(files, [5, 9, 1000]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 9]


def test_only_asked_frames_are_read_and_damage_is_seen(spark, tmp_path):
    files = token_files.write_token_files(docs(spark), str(tmp_path / "t"), PATH, end_id=1, files=1)
    path = files.collect()[0].path.removeprefix("file:")
    with open(path, "rb") as f:
        r = token_files.TokenFileReader(f)
        k = next(r.frames_of([3]))
        place = int(r.starts[k])
    data = bytearray(open(path, "rb").read())
    data[place + 8] ^= 255
    open(path, "wb").write(data)
    with open(path, "rb") as f:
        r = token_files.TokenFileReader(f)
        assert r.frame(next(r.frames_of([9])))
        with pytest.raises(Exception):  # noqa: B017  Zstandard's own error or CorruptFrame
            r.frame(k)


def test_empty_table(spark, tmp_path):
    none = docs(spark).limit(0)
    files = token_files.write_token_files(none, str(tmp_path / "t"), PATH, end_id=1)
    assert token_files.read_token_files(files).count() == 0
    assert packing.pack(none, PATH, end_id=2).count() == 0


def check_packed(rows, texts, window):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, t in texts:
        want[i].append([*plain(t), 2])
    for i, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, want[i]))
        if len(want[i]) == 1:
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == np.concatenate([[0], np.cumsum([r.length for r in own])[:-1]]).tolist()
            assert [x for r in own for x in np.frombuffer(bytes(r.ids), "<u4")] == want[i][0]
            assert {r.doc_tokens for r in own} == {len(want[i][0])}
    assert set(pieces) == set(want)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length == len(r.ids) // 4 > 0
            at += r.length
        assert at <= window
    return [sum(r.length for r in own) for own in sequences.values()]


def test_packing_keeps_every_id_once(spark):
    check_packed(packing.pack(docs(spark), PATH, end_id=2, window=4096).collect(), TEXTS, 4096)
    check_packed(packing.pack(docs(spark), PATH, end_id=2, window=16, open_windows=2).collect(), TEXTS, 16)


def test_packing_leaves_little_padding(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used = check_packed(packing.pack(d, PATH, end_id=2).collect(), [(r.doc_id, r.text) for r in d.collect()], 4096)
    assert sum(used) > 0.98 * 4096 * len(used)


def test_windows_best_fit_and_bound():
    w = packing.Windows(10, 2)
    assert w.place(6, "a") == [] and w.place(7, "b") == []
    assert w.place(3, "c") == [[(0, "b"), (7, "c")]]  # b's window has 3 left: full
    assert w.place(5, "d") == []
    assert w.place(9, "e") == [[(0, "a")]]  # fits none: the fullest goes
    assert w.rest() == [[(0, "d")], [(0, "e")]]


def test_registered_query_equals_encoding_every_text(spark):
    from foliomill.llm import queries

    rows = sorted(queries.QUERIES["op1_token_files"](spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert [r.doc_id for r in rows] == sorted(texts)
    at = 0
    for r in rows:
        ids = np.array([*plain(texts[r.doc_id]), 1], "<u4").tobytes()
        assert (r.start, r.ids_crc32, r.n_tokens) == (at, zlib.crc32(ids), len(ids) // 4)
        at += r.n_tokens


def test_rows_alike_fill_several_files(spark, tmp_path):
    rows = spark.createDataFrame([(7, "same text", "x", 1)] * 400 + [(8, "other", "x", 1)], SCHEMA).repartition(4)
    files = token_files.write_token_files(rows, f"file://{tmp_path}/t", PATH, end_id=1, files=4)
    sizes = [r.n_docs for r in files.collect()]
    assert sum(sizes) == 401 and len(sizes) > 2 and max(sizes) < 250
    got = token_files.read_token_files(files).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {7: 400, 8: 1}
    many = token_files.write_token_files(rows, f"{tmp_path}/u", PATH, end_id=1, file_bytes=500)
    assert many.count() > 4  # sizes come from the bytes of the texts
