"""The pipeline's stages, each against brute force over what the one before kept."""

from collections import defaultdict

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
from foliomill.llm import common, mixing, packing, quality
from pyspark.sql import functions as F
from test_quality import plain_counts
from test_simhash import plain_print, roots
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
CASES = [
    (9001, None, None, None, None), (9002, "", "xx", "src1", 0), (None, "only here " * 3 + " ".join(f"w{i}" for i in range(90)), "en", None, 1),
    (9003, " ".join(f"v{i}" for i in range(100)), "en", "src1", 1), (9003, " ".join(f"v{i}" for i in range(100)), "en", "src1", 1),
    (9004, " ".join(f"v{i}" for i in range(100)), "en", "src2", 1), (9005, " ".join(f"u{i}" for i in range(30000)), "en", "src2", 1),
]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(CASES, docs.schema))
    before = docs.collect()
    rules = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    after = [tuple(r) for r in pipeline.STAGES[0][1](spark, docs, SF).collect()]

    def kept(text):
        c = dict(zip(quality.COUNTS, quality.text_counts(text), strict=True))
        assert tuple(c.values())[:5] == plain_counts(text)
        ratio = lambda a, b: c[a] / max(1, c[b])
        x = {n: np.array([float(v)]) for n, v in plain_statistics(ratio, c).items()}
        return c["n_words"] >= 50 and 100 * c["n_repeat_words"] <= 50 * c["n_words"] and not any(r.meets(x)[0] for r in rules)

    assert sorted(map(str, after)) == sorted(str(tuple(r)) for r in before if kept(r.text))

    docs = spark.createDataFrame(after, docs.schema)
    unique = [tuple(r) for r in pipeline.STAGES[1][1](spark, docs, SF).collect()]
    prints = [plain_print(r[1]) for r in after]
    group = roots(range(len(after)), [(a, b) for a in range(len(after)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    by = defaultdict(list)
    for k, r in enumerate(after):
        by[group[k]].append((r[0] is None, r[0] or 0, str(r)))
    assert sorted(str(r) for r in unique) == sorted(min(own)[2] for own in by.values())

    docs = spark.createDataFrame(unique, docs.schema)
    mixed = pipeline.STAGES[2][1](spark, docs, SF)
    assert mixed.columns == docs.columns
    assert sorted(str(tuple(r)) for r in mixed.collect()) == sorted(map(str, unique))

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in pipeline.STAGES[3][1](spark, docs, SF).collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    assert {i: b"".join(x for _, x in sorted(own)) for i, own in pieces.items()} == {
        r[0]: np.array([*t.encode(r[1], add_special_tokens=False).ids, 2], "<u4").tobytes() for r in unique
    }


def plain_statistics(ratio, c):
    return {
        "words": c["n_words"], "word_length": ratio("word_chars", "n_words"), "symbols": ratio("n_symbols", "word_chars"),
        "capitals": ratio("n_capitals", "word_chars"), "marks": ratio("n_marks", "n_words"),
        "repeated_lines": ratio("n_dup_lines", "n_lines"), "repeated_words": ratio("n_repeat_words", "n_words"),
        "distinct_words": ratio("n_distinct_words", "n_words"), "words_in_a_line": ratio("n_words", "n_lines"),
    }


def test_run_and_empty_documents(spark, tmp_path):
    rows = pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset", "doc_tokens", "ids_crc32"} == set(rows.columns)
    assert rows.count() > 0
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_sequences_follow_the_mixing_schedule(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["doc_id"])
    slots = {r.doc_id: r.slot_ for r in mixing.mix(docs).select("doc_id", "slot_").collect()}
    mixed = pipeline.mix_sources(spark, docs, SF)
    order = [r.doc_id for r in mixed.select("doc_id").collect()]
    mixed.write.parquet(f"{tmp_path}/mixed")
    again = spark.read.parquet(f"{tmp_path}/mixed")
    assert [r.doc_id for r in common.in_written_order(again).collect()] == order
    assert common.in_written_order(again).columns == docs.columns
    spans = {}
    for r in pipeline.pack_sequences(spark, again, SF).filter(F.col("sequence_id") < packing.MERGED).collect():
        spans.setdefault(r.sequence_id >> 32, []).append(slots[r.doc_id])
    assert len(spans) > 1 and len(set(slots.values())) > 4
    spans = [spans[p] for p in sorted(spans)]
    assert all(max(a) <= min(b) for a, b in zip(spans, spans[1:]))  # noqa: B905
