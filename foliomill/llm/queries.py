"""The queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.llm import ann, chat, common, impacts, licenses, mixing, packing, pivots, prefix_trie, quality, sharding, simhash, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_files(spark, sf_dir):
    files = token_files.write_token_files(
        table(spark, sf_dir, "documents"), common.shared_folder(spark, "tokens"),
        public_tokenizers.path("word_bpe_49k.json"), end_id=1,
    )
    rows = token_files.read_token_files(files)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op3_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return quality.judge(docs, rules).select("doc_id", *[f"quality_.{c}" for c in columns])


@query
def op8_sharding(spark, sf_dir):
    rows = sharding.shard(table(spark, sf_dir, "documents"), 16)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return rows.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_mixing(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))  # whole texts go through the exchanges
    return rows.select(
        "doc_id", "source", F.col("size_").alias("size"), crc.alias("text_crc32"), F.col("block_").alias("block"), F.col("slot_").alias("slot")
    )


@query
def op2_license_scan(spark, sf_dir):
    rows = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    starts = F.transform("places", lambda p: p["word"])
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


@query
def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op4_additive_quantisation(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query
def op6_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    turns = turns.unionByName(spark.createDataFrame(added, turns.schema))
    return chat.digests(chat.format_chats(turns, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op11_impact_search(spark, sf_dir):
    return impacts.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_pivot_near_dedup(spark, sf_dir):
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


# What SQL can express of the operators' results, each taken from the operator's own query.
def part(sql: str):
    def add(f):
        SQL[f.__name__] = sql
        return query(f)

    return add


_HOSTS = """
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""


def _rule_case(value: int) -> str:
    cases = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[value]}'"
        for h, p, v in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    ]
    return f"CASE {' '.join(cases)} END"


@part(f"SELECT page_id, host, path, {_rule_case(0)} AS rule, {_rule_case(1)} AS ruled FROM ({_HOSTS})")
def url_rules(spark, sf_dir):
    rows = op9_url_filter(spark, sf_dir)
    return rows.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


# Without links between hosts a seed alone decides: over a quarter of a host's pages blocked, and more than are allowed.
@part(f"""
    WITH r AS (SELECT *, {_rule_case(1)} AS ruled FROM ({_HOSTS})),
      h AS (SELECT host, avg(CASE WHEN ruled = 'block' THEN 1 ELSE 0 END) AS bad, avg(CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END) AS good FROM r WHERE host <> '' GROUP BY host)
    SELECT r.page_id, coalesce(ruled, CASE WHEN h.bad > 0.25 AND h.bad > h.good THEN 'block' ELSE 'allow' END) AS verdict FROM r LEFT JOIN h USING (host)
""")
def url_verdicts_without_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("html", F.lit(None).cast("string"))
    return url_filter.judge(pages).select("page_id", "verdict")


_LICENSE_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _phrase_places(phrase: str) -> str:
    own = phrase.split()
    here = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(own))
    return f"list_filter(range(1, len(w) - {len(own) - 2}), lambda i: {here})"


@part(f"""
    WITH d AS (SELECT doc_id, {_LICENSE_WORDS} AS w FROM documents), p AS (SELECT doc_id, len(w) AS n_words, {", ".join(f"{_phrase_places(p)} AS p{k}" for k, p in enumerate(licenses.PHRASES))} FROM d),
      a AS (SELECT *, list_concat({", ".join(f"p{k}" for k in range(len(licenses.PHRASES)))}) AS places FROM p)
    SELECT doc_id, n_words, len(places) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
      coalesce(array_to_string(list_sort(list_filter([{", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{x}' END" for k, x in enumerate(licenses.PHRASES.values()))}], lambda x: x IS NOT NULL)), ','), '') AS base_labels FROM a
""")
def license_base_places(spark, sf_dir):
    return op2_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


@part(r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
      g AS (SELECT doc_id, i, w[i:i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
      t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
      c AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM t) GROUP BY doc_id),
      l AS (SELECT doc_id, w, text, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled FROM d),
      a AS (SELECT l.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(filled) - len(list_distinct(filled)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM l LEFT JOIN c USING (doc_id))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a
""")
def quality_base_counts(spark, sf_dir):
    return op5_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@part("""
    WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256 FROM t GROUP BY conv_id
""")
def chat_turns(spark, sf_dir):
    return op6_chat_format(spark, sf_dir).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


@part("SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, 'bytes' AS law FROM documents")
def shard_sizes(spark, sf_dir):
    return op8_sharding(spark, sf_dir).select("doc_id", "size", "law")


@part("SELECT 16 AS shards, count(*) AS rows, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes, true AS gapless, true AS near_equal FROM documents")
def shard_balance(spark, sf_dir):
    """One row: slots of each shard run from 0 without gaps, and no shard is off the mean by more than the longest text."""
    rows = op8_sharding(spark, sf_dir)
    each = rows.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.count_distinct("slot").alias("slots"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.max("size").alias("longest"))
    whole = (F.col("slots") == F.col("n")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)
    near = F.greatest(F.max("bytes") - F.avg("bytes"), F.avg("bytes") - F.min("bytes")) <= F.max("longest") + 0.001 * F.avg("bytes")
    return each.agg(F.count("*").cast("int").alias("shards"), F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), F.bool_and(whole).alias("gapless"), near.alias("near_equal"))


@part("SELECT source, count(*) AS rows, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes, CAST(0 AS BIGINT) AS first_block, true AS all_blocks_in_order FROM documents GROUP BY source")
def mixing_by_source(spark, sf_dir):
    """Every row of a source once, its blocks in the order of their slots, one slot each."""
    rows = op7_mixing(spark, sf_dir)
    blocks = rows.groupBy("source", "block").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("slot").alias("slot"), F.max("slot").alias("last"))
    before = Window.partitionBy("source").orderBy("block")
    ordered = (F.col("slot") == F.col("last")) & (F.coalesce(F.lag("slot").over(before), F.lit(-1)) < F.col("slot"))
    blocks = blocks.withColumn("ordered", ordered)
    return blocks.groupBy("source").agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), F.min("block").alias("first_block"), F.bool_and("ordered").alias("all_blocks_in_order"))


SQL["op13_pivot_near_dedup"] = """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
      ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda a: a IS NULL OR isnan(a) OR isinf(a))) = 0 AND len(list_filter(x, lambda a: a <> 0)) > 0),
      p AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
      r AS (SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u)
    SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept FROM v
      JOIN (SELECT u, min(v) AS component_id FROM r GROUP BY u) c ON v.vec_id = c.u LEFT JOIN (SELECT u, count(*) AS n FROM p GROUP BY u) k ON v.vec_id = k.u
"""

# CRC-32 of decimal numbers: byte by byte, eight steps each.
_CRC = "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)), lambda s, x: list_reduce(list_prepend(xor(s, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda r, k: xor(r >> 1, 3988292384::UBIGINT * (r & 1))))"
SQL["op12_prefix_trie"] = f"""
    WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
      c AS (SELECT c, c - c % 5 AS base, (xor({_CRC}, 4294967295::UBIGINT) % 9)::BIGINT AS h FROM (SELECT DISTINCT c FROM t)),
      m AS (SELECT c.c, 0 AS own, t.p, {{'r': t.role, 't': t.text}} AS turn FROM c JOIN t ON t.c = c.base WHERE t.p <= c.h UNION ALL SELECT c.c, 1, t.p, {{'r': t.role, 't': t.text}} FROM c JOIN t USING (c) WHERE t.p > c.h),
      l AS (SELECT c.c, coalesce(turns, []) AS turns FROM c LEFT JOIN (SELECT c, list(turn ORDER BY own, p) AS turns FROM m GROUP BY c) USING (c)),
      d AS (SELECT c, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM l),
      k AS (SELECT c, n, depth, turns[:depth] AS k FROM d),
      nodes AS (SELECT k, depth, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CASE WHEN n = depth THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends, CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(k[depth]['t']) END AS saved FROM k GROUP BY k, depth),
      kids AS (SELECT k[:depth - 1] AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
      full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (k)),
      up AS (SELECT k[:j] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM full_) GROUP BY 1)
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves, up.saved_tokens, sha256(f.ends) AS ends_sha256
    FROM full_ f JOIN up USING (k) LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.k = f.k[:f.depth - 1]
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op11_impact_search"] = f"""
    WITH d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
      s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM d),
      q AS (SELECT item_id, unnest(w) AS term FROM (SELECT item_id, {_TERMS} AS w FROM benchmark)),
      t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
      f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, n_docs),
      r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // l))))::BIGINT AS score FROM q JOIN t USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
