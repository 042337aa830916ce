"""The corpus pipeline: quality rules, near-duplicates, mixing, packing, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared
folder and rereads them as the next one's docs. Nulls, repeated rows, empty and very long texts are
treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import common, mixing, packing, quality, simhash

#: SQL cannot express learned rules, fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list rejects."""
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, rules).filter("quality_.kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents in the order of the sources' schedule, by partition and by row; once written, files and their rows
    keep it, and packing takes them in that order."""
    return mixing.mix(docs).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids. Sequences are numbered along the order in which docs were written;
    docs that are not read from files have no such order and are packed as they come."""
    return packing.pack(common.in_written_order(docs.select("doc_id", "text")), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", keep_quality), ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources), ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; a row for each piece, ids as their CRC-32."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    pieces = STAGES[-1][1](spark, docs, sf_dir)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
