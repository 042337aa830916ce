"""Registered queries, each one operator over whole tables, and the DuckDB SQL that each is compared with."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.functions import charsets
from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.operators import boxes, detection, errors, order, rollup
from foliomill.plans import reports, tasks
from foliomill.sinks import alto as out_alto
from foliomill.sinks import exports, paths
from foliomill.sources import alto, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register the decorated function under its name, with its DuckDB equivalent where SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Boxes on pages, as the tables have none: an order is a page, a line item a box.
BOXES = """
    SELECT l_orderkey AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS idx,
      CAST(l_partkey % 2000 AS INT) AS x1, CAST(l_suppkey % 100 * 20 AS INT) AS y1, CAST(l_partkey % 2000 + CAST(l_quantity AS INT) * 10 AS INT) AS x2,
      CAST(l_suppkey % 100 * 20 + 40 AS INT) AS y2, l_returnflag AS flag FROM lineitem
"""
IOU = """
    CASE WHEN least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1)
      THEN CAST((least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS DOUBLE)
        / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
           - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)))
      ELSE 0 END
"""


def page_boxes(spark, sf_dir) -> DataFrame:
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    # named page before its rows are gathered: else Spark does not see that they are, and shuffles them by page again
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), *keys, "l_quantity", F.col("l_returnflag").alias("flag"))
    rows = rows.withColumn("idx", F.row_number().over(Window.partitionBy("page").orderBy(*keys)))
    x1, y1 = (F.col("l_partkey") % 2000).cast("int"), (F.col("l_suppkey") % 100 * 20).cast("int")
    box = G.box(x1, y1, x1 + F.col("l_quantity").cast("int") * 10, y1 + 40)
    return rows.select("page", "idx", box.alias("box"), "flag")


def flat(rows: DataFrame) -> DataFrame:
    return rows.select([c for c in rows.columns if c != "box"] + (["box.*"] if "box" in rows.columns else []))


def document_lines(spark, sf_dir) -> DataFrame:
    """(doc_id, idx, text) of all lines, blank ones included."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))


LINES = "SELECT doc_id, CAST(i AS INT) - 1 AS idx, l AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(ls) WITH ORDINALITY AS u(l, i)"


@query(f"""
    WITH lines AS ({LINES}), kept AS (
      SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY idx) AS before FROM lines),
    clean AS (SELECT doc_id, trim(text, ' ') AS t FROM kept WHERE NOT (text <> '' AND text IS NOT DISTINCT FROM before))
    SELECT doc_id, count(*) AS n_lines, CAST(sum(length(t)) AS BIGINT) AS n_chars,
      CAST(sum(len(regexp_extract_all(t, '[^\\s]+'))) AS BIGINT) AS n_words
    FROM clean WHERE t <> '' GROUP BY doc_id
""")
def doc_lines_profile(spark, sf_dir):
    lines = order.without_repeats(document_lines(spark, sf_dir), ["doc_id"]).withColumn("t", F.trim("text")).filter("t <> ''")
    count = lambda c: F.sum(c.cast("long"))
    words = F.size(F.regexp_extract_all("t", F.lit(r"\S+"), F.lit(0)))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), count(F.length("t")).alias("n_chars"), count(words).alias("n_words"))


@query(f"""
    WITH lines AS ({LINES}), b AS (SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY idx) AS before FROM lines)
    SELECT doc_id, idx, md5(text) AS digest FROM b WHERE NOT (text <> '' AND text IS NOT DISTINCT FROM before)
""")
def dedup_consecutive_lines(spark, sf_dir):
    return order.without_repeats(document_lines(spark, sf_dir), ["doc_id"]).select("doc_id", "idx", F.md5("text").alias("digest"))


def _quoted(text: str) -> str:
    return text.replace("'", "''")


_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace({x}, '\[\.{2,}\]|\[…\]', '', 'g'), '<[^>]*>', '', 'g'), '\[([^\]]*)\]', '\1', 'g')"""


_NORMS = f"translate({_CLEAN.replace('{x}', 'html')}, '{_quoted(''.join(charsets.BASE_NORMS))}', '{_quoted(''.join(charsets.BASE_NORMS.values()))}')"


@query(f"SELECT page_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n FROM (SELECT page_id, {_NORMS} AS t FROM pages)")
def clean_markup(spark, sf_dir):
    text = T.normalised(T.without_markup(F.col("html")))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("n"))


def _allowed() -> str:
    """The allowed characters as an explicit class: DuckDB's expressions have no intersection of classes."""
    own = {ord(c) for x in (charsets.COMBINING, charsets.MEDIEVAL, charsets.SUPERSCRIPT) for s in x for c in s} | {9, 10, 13, 32}
    own |= {c for c in range(0x20, 0x250) if unicodedata.category(chr(c))[0] in "LNPZM"}
    own |= {c for c in range(0x1E00, 0x1F00) if unicodedata.category(chr(c))[0] in "LM"}
    return "".join(f"\\x{{{c:X}}}" for c in sorted(own))


_CLEANED = f"regexp_replace({_NORMS}, '[^{_allowed()}]', '', 'g')"


@query(f"SELECT page_id, md5(t) AS digest, CAST(length(t) AS INT) AS n FROM (SELECT page_id, {_CLEANED} AS t FROM pages)")
def clean_text(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", T.cleaned(F.col("html")).alias("t"))
    return rows.select("page_id", F.md5("t").alias("digest"), F.length("t").alias("n"))


@query(f"SELECT doc_id, md5(t) AS digest FROM (SELECT doc_id, regexp_replace(text, '[^{_allowed()}]', '', 'g') AS t FROM documents)")
def whitelist_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.only_allowed(F.col("text"))).alias("digest"))


@query(r"""
    SELECT doc_id, CAST(length(regexp_replace(text, '[^éèàùç]', '', 'g')) AS DOUBLE) / length(text) AS density FROM documents WHERE text <> ''
""")
def char_density(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", T.density(F.col("text"), "éèàùç").alias("density"))


# DuckDB's distance counts bytes, so its SQL gives each sign beyond ASCII a control character of its own, one to one.
_CODES = f"concat({', '.join(f'chr({i})' for i in (*range(1, 9), *range(14, 32)))})"


def _coded(text: str, of: str = "SELECT text FROM conversations") -> str:
    signs = f"SELECT coalesce(string_agg(DISTINCT c, '' ORDER BY c), '') FROM (SELECT unnest(regexp_extract_all(text, '[^\\x00-\\x7F]')) AS c FROM ({of}))"
    return f"translate({text}, ({signs}), {_CODES})"


_PAIRS = f"""
    SELECT a.conv_id, a.turn, a.text AS truth, b.text AS found, {_coded("a.text")} AS truth_code, {_coded("b.text")} AS found_code
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn
"""


def turn_pairs(spark, sf_dir) -> DataFrame:
    """Neighbouring turns as a truth and a reading."""
    turns = table(spark, sf_dir, "conversations")
    truth = turns.select("conv_id", "turn", F.col("text").alias("truth"))
    return truth.join(turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("found")), ["conv_id", "turn"])


@query(f"SELECT conv_id, turn, CAST(levenshtein(truth_code, found_code) AS INT) AS char_edits, CAST(length(truth) AS INT) AS chars FROM ({_PAIRS})")
def cer_pairs(spark, sf_dir):
    return errors.with_edits(turn_pairs(spark, sf_dir)).select("conv_id", "turn", "char_edits", "chars")


@query(f"""
    SELECT round(sum(levenshtein(truth_code, found_code)) / sum(length(truth)), 9) AS cer, round(1 - sum(levenshtein(truth_code, found_code)) / sum(length(truth)), 9) AS char_accuracy,
      CAST(sum(length(found)) AS BIGINT) AS total_chars, count(*) AS pairs FROM ({_PAIRS})
""")
def cer_corpus(spark, sf_dir):
    rates = errors.rates(errors.with_edits(turn_pairs(spark, sf_dir)))
    return rates.select(F.round("cer", 9).alias("cer"), F.round("char_accuracy", 9).alias("char_accuracy"), "total_chars", "pairs")


# A row of the distance table for each word; insertions along a row are the least value before, less the steps from there.
@query(f"""
    WITH RECURSIVE p AS (SELECT conv_id, turn, regexp_extract_all(truth, '[^\\s]+') AS x, regexp_extract_all(found, '[^\\s]+') AS y FROM ({_PAIRS})),
      d AS (SELECT conv_id, turn, 0 AS i, x, y, range(0, len(y) + 1) AS r FROM p UNION ALL
        SELECT conv_id, turn, i + 1, x, y, list_transform(c, lambda v, j: list_min(c[1:j]) + j - 1) FROM (
          SELECT conv_id, turn, i, x, y, list_transform(r, lambda v, j: (CASE WHEN j = 1 THEN i + 1
            ELSE least(r[j - 1] + CASE WHEN x[i + 1] = y[j - 1] THEN 0 ELSE 1 END, v + 1) END) - j + 1) AS c FROM d WHERE i < len(x)))
    SELECT conv_id, turn, CAST(r[len(y) + 1] AS INT) AS word_edits, CAST(len(x) AS INT) AS words, CAST(len(y) AS INT) AS found_words FROM d WHERE i = len(x)
""")
def wer_pairs(spark, sf_dir):
    return errors.with_edits(turn_pairs(spark, sf_dir)).select("conv_id", "turn", "word_edits", "words", "found_words")


@query()
def error_operations(spark, sf_dir):
    return errors.operations(turn_pairs(spark, sf_dir))


@query(f"""
    WITH s AS (SELECT CAST(conv_id AS VARCHAR) AS file, round(sum(levenshtein(truth_code, found_code)) / sum(length(truth)), 9) AS cer FROM ({_PAIRS}) GROUP BY conv_id)
    SELECT rank, file, cer FROM (SELECT row_number() OVER (ORDER BY cer DESC NULLS LAST, file) AS rank, file, cer FROM s) WHERE rank <= 5
""")
def worst_pages_top5(spark, sf_dir):
    scores = errors.page_scores(errors.with_edits(turn_pairs(spark, sf_dir)), ["conv_id"]).withColumn("cer", F.round("cer", 9))
    return errors.worst(scores, name=F.col("conv_id").cast("string"))


@query(f"""
    WITH a AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(regexp_extract_all(truth, '[^\\s]+')) AS w FROM ({_PAIRS})) GROUP BY ALL),
      b AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(regexp_extract_all(found, '[^\\s]+')) AS w FROM ({_PAIRS})) GROUP BY ALL)
    SELECT p.conv_id, p.turn, CAST(coalesce(sum(CASE WHEN b.n IS NULL THEN 0 ELSE least(a.n, b.n) END), 0) AS BIGINT) AS common
    FROM ({_PAIRS}) p LEFT JOIN a ON a.conv_id = p.conv_id AND a.turn = p.turn LEFT JOIN b ON b.conv_id = a.conv_id AND b.turn = a.turn AND b.w = a.w
    GROUP BY p.conv_id, p.turn
""")
def word_bag_overlap(spark, sf_dir):
    return errors.word_overlap(turn_pairs(spark, sf_dir), ["conv_id", "turn"])


def _decomposed(text: str) -> str:
    """DuckDB has no decomposition: the letters up to U+017F that have one are replaced by it."""
    for c in map(chr, range(0xC0, 0x180)):
        if (parts := unicodedata.normalize("NFD", c)) != c:
            text = f"replace({text}, '{c}', '{parts}')"
    return text


_NFD = f"SELECT conv_id, turn, {_decomposed('text')} AS text FROM conversations"


@query(f"""
    WITH n AS ({_NFD}), t AS (SELECT conv_id, turn, length(text) AS size, {_coded("text", "SELECT text FROM n")} AS text FROM n)
    SELECT round(sum(levenshtein(a.text, b.text)) / sum(a.size), 9) AS cer, count(*) AS matched_lines FROM t a JOIN t b ON a.conv_id = b.conv_id - 1 AND a.turn = b.turn
""")
def competition_join(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations")
    found = errors.matched_lines(lines, lines.withColumn("conv_id", F.col("conv_id") - 1), ["conv_id", "turn"])
    return found.select(F.round("cer", 9).alias("cer"), "matched_lines")


@query(f"""
    WITH n AS (SELECT doc_id, count(*) AS n FROM ({LINES}) GROUP BY doc_id),
      f AS (SELECT d.doc_id, n.n AS lines, len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '')) AS parts FROM documents d JOIN n USING (doc_id))
    SELECT doc_id, CASE WHEN lines > 1 AND lines = parts THEN 'line' WHEN lines > 1 THEN 'joined' ELSE 'whole' END AS mode,
      CASE WHEN lines > 1 AND lines = parts THEN parts ELSE 1 END AS pairs FROM f WHERE parts > 0
""")
def pairing_modes(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("idx"), "text")
    rows = errors.pairing_modes(document_lines(spark, sf_dir), found, ["doc_id"])
    return rows.groupBy("doc_id", "mode").agg(F.count("*").alias("pairs"))


@query(f"""
    WITH b AS ({BOXES}), gone AS (
      SELECT DISTINCT a.page, CASE WHEN (a.x2 - a.x1) * (a.y2 - a.y1) < (b.x2 - b.x1) * (b.y2 - b.y1) THEN a.idx ELSE b.idx END AS idx
      FROM b a JOIN b ON a.page = b.page AND a.idx < b.idx WHERE {IOU} > 0.5)
    SELECT page, idx, x1, y1, x2, y2 FROM b WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.page = b.page AND g.idx = b.idx)
""")
def nms(spark, sf_dir):
    return flat(boxes.suppressed(page_boxes(spark, sf_dir), ["page"]).drop("flag"))


@query(f"""
    WITH b AS ({BOXES}), p AS (SELECT a.page, a.idx AS i, b.idx AS j, round({IOU}, 9) AS iou FROM b a JOIN b ON a.page = b.page AND a.idx < b.idx)
    SELECT page, i, j, iou FROM p WHERE iou > 0
""")
def iou_pairs(spark, sf_dir):
    rows = page_boxes(spark, sf_dir)
    rows = boxes.overlaps(rows, rows, ["page"], F.col("a_idx") < F.col("b_idx"))
    return rows.select("page", F.col("a_idx").alias("i"), F.col("b_idx").alias("j"), F.round("iou", 9).alias("iou")).filter("iou > 0")


@query(f"""
    WITH b AS ({BOXES}), m AS (SELECT a.page, a.idx, b.idx AS zone, {IOU} AS iou FROM b a JOIN b ON a.page = b.page WHERE a.idx > 2 AND b.idx <= 2),
      best AS (SELECT page, idx, zone, iou FROM (SELECT *, row_number() OVER (PARTITION BY page, idx ORDER BY iou DESC, zone) AS n FROM m WHERE iou >= 0.001) WHERE n = 1)
    SELECT b.page, b.idx, best.zone, round(best.iou, 9) AS iou FROM b LEFT JOIN best ON b.page = best.page AND b.idx = best.idx WHERE b.idx > 2
""")
def zone_assignment(spark, sf_dir):
    rows = page_boxes(spark, sf_dir)
    found = boxes.assigned(rows.filter("idx > 2"), rows.filter("idx <= 2"), ["page"])
    return found.select("page", "idx", "zone", F.round("iou", 9).alias("iou"))


@query(f"""
    WITH b AS ({BOXES}), s AS (SELECT a.page, a.idx AS gt, b.idx AS dt,
      greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS shared,
      (a.x2 - a.x1) * (a.y2 - a.y1) AS aa, (b.x2 - b.x1) * (b.y2 - b.y1) AS bb
      FROM b a JOIN b ON a.page = b.page WHERE a.flag = 'R' AND b.flag <> 'R')
    SELECT page, gt, dt, round(pow(CAST(shared AS DOUBLE) / aa, 2) + pow(CAST(shared AS DOUBLE) / bb, 2), 9) AS strength FROM s WHERE shared > 0
""")
def link_table(spark, sf_dir):
    rows = page_boxes(spark, sf_dir)
    links = boxes.link_table(rows.filter("flag = 'R'"), rows.filter("flag <> 'R'"), ["page"])
    return links.withColumn("strength", F.round("strength", 9))


@query(f"SELECT page, idx, CAST(row_number() OVER (PARTITION BY page ORDER BY floor(y1 / 10), x1, idx) AS INT) AS position FROM ({BOXES})")
def reading_order_rows(spark, sf_dir):
    keys = boxes.in_rows(F.col("box.y1"), F.col("box.x1"))
    return page_boxes(spark, sf_dir).select("page", "idx", boxes.position(keys, ["page"]).alias("position"))


@query(f"""
    WITH b AS (SELECT *, (x1 + x2) / 2.0 AS cx FROM ({BOXES})),
      g AS (SELECT *, CASE WHEN cx - lag(cx) OVER (PARTITION BY page ORDER BY cx, idx) <= 300 THEN 0 ELSE 1 END AS fresh FROM b),
      c AS (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY cx, idx ROWS UNBOUNDED PRECEDING) AS col FROM g)
    SELECT page, idx, CAST(row_number() OVER (PARTITION BY page ORDER BY col, y1, cx, idx) AS INT) AS position FROM c
""")
def reading_order_columns(spark, sf_dir):
    zones = order.with_first_y(page_boxes(spark, sf_dir), None, ["page"])
    return order.reading_order(zones, ["page"], "dbscan").select("page", "idx", "position")


@query()
def reading_order_heatmap(spark, sf_dir):
    zones = order.with_first_y(page_boxes(spark, sf_dir), None, ["page"])
    return order.reading_order(zones, ["page"], "heatmap").select("page", "idx", "position")


@query()
def reading_order_hybrid(spark, sf_dir):
    zones = order.with_first_y(page_boxes(spark, sf_dir), None, ["page"])
    return order.reading_order(zones, ["page"], "hybrid").select("page", "idx", "position")


@query(f"SELECT page, idx, CAST(trunc(100 * x1 / 2500.0) AS INT) AS x1, CAST(trunc(100 * y1 / 2100.0) AS INT) AS y1, CAST(trunc(100 * x2 / 2500.0) AS INT) AS x2, CAST(trunc(100 * y2 / 2100.0) AS INT) AS y2 FROM ({BOXES})")
def box_normalise(spark, sf_dir):
    return flat(page_boxes(spark, sf_dir).select("page", "idx", G.on_grid(F.col("box"), F.lit(2500), F.lit(2100)).alias("box")))


@query(f"""
    SELECT page, idx, printf('%d %.6f %.6f %.6f %.6f', 1, least(1.0, (x1 + x2) / 2.0 / 2500), least(1.0, (y1 + y2) / 2.0 / 2100), least(1.0, (x2 - x1) / 2500.0), least(1.0, (y2 - y1) / 2100.0)) AS value
    FROM ({BOXES})
""")
def yolo_format(spark, sf_dir):
    row = G.detection_row(F.lit(1), F.col("box"), F.lit(2500), F.lit(2100))
    return page_boxes(spark, sf_dir).select("page", "idx", row.alias("value"))


def _lines_of(rows: DataFrame) -> DataFrame:
    corners = G.polygon(F.col("box")).cast(G.POINTS)
    text = F.concat_ws(" ", F.lit("w"), F.col("idx").cast("string"))
    others = [c for c in rows.columns if c not in ("page", "idx", "box", "flag")]
    return rows.select("page", *others, F.col("idx").cast("long").alias("idx"), corners.alias("boundary"), F.lit(None).cast(G.POINTS).alias("baseline"), text.alias("text"))


def _zones_of(spark, sf_dir) -> DataFrame:
    """Boxes as zones: those of flag R are the truth, those of another are found."""
    rows = page_boxes(spark, sf_dir).filter("flag is not null")
    return _lines_of(rows.withColumn("side", F.when(F.col("flag") == "R", 0).otherwise(1)))


@query()
def zone_map_pages(spark, sf_dir):
    return detection.zone_map_of(_zones_of(spark, sf_dir), ["page"])


@query(f"""
    WITH b AS ({BOXES}), gt AS (SELECT * FROM b WHERE flag = 'R')
    SELECT page, CAST(sum((x2 - x1) * (y2 - y1)) AS DOUBLE) AS gt_area FROM gt GROUP BY page
""")
def zone_map_truth_area(spark, sf_dir):
    stats = detection.zone_map_of(_zones_of(spark, sf_dir), ["page"])
    return stats.filter("gt_area > 0").select("page", F.round("gt_area", 6).alias("gt_area"))


@query()
def zone_map_corpus(spark, sf_dir):
    return detection.zone_map_scores(zone_map_pages(spark, sf_dir))


# Found boxes of a page take, one after the other, the free true box of most IoU. All have one confidence: a curve of one point.
@query(f"""
    WITH RECURSIVE b AS ({BOXES}), f AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY idx) AS k FROM b WHERE idx % 2 = 1),
      m AS (SELECT a.page, a.k, list({{'iou': {IOU}, 'idx': b.idx}} ORDER BY {IOU} DESC, b.idx) AS near FROM f a JOIN b ON a.page = b.page AND b.idx % 2 = 0 GROUP BY ALL),
      th AS (SELECT round(0.5 + 0.05 * i, 2) AS threshold FROM range(10) t(i)),
      s AS (SELECT DISTINCT m.page, th.threshold, 0 AS k, CAST([] AS INT[]) AS used, 0 AS hit FROM m, th UNION ALL
        SELECT page, threshold, k, CASE WHEN best.iou >= threshold THEN list_append(used, best.idx) ELSE used END, CASE WHEN best.iou >= threshold THEN 1 ELSE 0 END FROM (
          SELECT s.page, s.threshold, m.k, s.used, list_filter(m.near, lambda x: NOT list_contains(s.used, x.idx))[1] AS best FROM s JOIN m ON m.page = s.page AND m.k = s.k + 1)),
      c AS (SELECT CAST(threshold AS DOUBLE) AS threshold, sum(hit) AS tp, count(*) AS n, (SELECT count(*) FROM b WHERE idx % 2 = 0) AS total FROM s WHERE k > 0 GROUP BY threshold)
    SELECT threshold, round(tp / n * tp / total, 9) AS ap, round(tp / n, 9) AS precision, round(tp / total, 9) AS recall FROM c
""")
def map_eval(spark, sf_dir):
    rows = page_boxes(spark, sf_dir)
    truth = rows.filter("idx % 2 = 0").select("page", "idx", "box")
    found = rows.filter("idx % 2 = 1").select("page", F.col("idx").cast("long").alias("idx"), "box", F.lit(1.0).alias("confidence"))
    curve = detection.average_precision(detection.hits(truth, found, ["page"]), truth)
    return curve.select("threshold", *[F.round(c, 9).alias(c) for c in ("ap", "precision", "recall")])


@query("SELECT DISTINCT o_orderkey AS page FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def resume_antijoin(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("page")).distinct()
    return files.remaining(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page")), done, ["page"]).distinct()


@query("""
    WITH f AS (SELECT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS folder FROM documents)
    SELECT count(*) FILTER (WHERE folder IS NULL) AS n_root, count(DISTINCT folder) AS n_folders,
      CASE WHEN count(*) FILTER (WHERE folder IS NULL) > 0 AND count(folder) > 0 THEN 'mixed' WHEN count(folder) > 0 THEN 'hierarchical'
        WHEN count(*) > 0 THEN 'flat' ELSE 'empty' END AS kind FROM f
""")
def structure_kind(spark, sf_dir):
    folder = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    listed = table(spark, sf_dir, "documents").select(folder.alias("folder")).withColumn("depth", F.col("folder").isNotNull().cast("int"))
    return files.structure(listed).select("n_root", "n_folders", "kind")


@query("SELECT DISTINCT p_type, CAST(concat('0x', substr(sha1(p_type), 1, 6)) AS BIGINT) % 100000 AS tag, concat('BT', substr(sha1(p_type), 1, 6)) AS short FROM part")
def tag_ids(spark, sf_dir):
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    return types.select("p_type", G.tag_id(F.col("p_type")).alias("tag"), G.short_tag(F.col("p_type")).alias("short"))


@query("""
    WITH s AS (SELECT source AS document, avg(n_chars) AS score, sum(n_chars) AS total FROM documents GROUP BY source)
    SELECT 'score/chars' AS key, round(avg(score), 6) AS value FROM s UNION ALL SELECT 'total/chars', CAST(sum(total) AS DOUBLE) FROM s
""")
def aggregate_metrics(spark, sf_dir):
    by = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("document"))
    wide = by.agg(F.avg("n_chars").alias("score/chars"), F.sum("n_chars").cast("double").alias("total/chars"))
    rows = rollup.over_documents(rollup.long_form(wide, ["document"], ["score/chars", "total/chars"]))
    return rows.select("key", F.round("value", 6).alias("value"))


def labelled(spark, sf_dir) -> DataFrame:
    language = F.element_at(F.create_map(*[F.lit(x) for x in ("fr", "French", "es", "Castillan", "en", "English", "de", "German")]), F.col("lang"))
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", language.alias("language"), "source", F.lit(1).cast("long").alias("pages"), F.col("quality").cast("double").alias("quality"), F.col("n_chars").cast("double").alias("chars"))


_LABELLED = """
    SELECT CASE lang WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Castillan' WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' END AS language,
      source, CAST(quality AS DOUBLE) AS quality, CAST(n_chars AS DOUBLE) AS chars FROM documents JOIN labels USING (doc_id)
"""
_STATS = f"""
    WITH l AS ({_LABELLED}), f AS (SELECT 'language' AS feature, language AS value, quality, chars FROM l UNION ALL SELECT 'source', source, quality, chars FROM l),
      m AS (SELECT feature, value, 'quality' AS metric, quality AS score FROM f UNION ALL SELECT feature, value, 'chars', chars FROM f),
      stats AS (SELECT feature, value, metric, avg(score) AS mean, stddev_samp(score) AS std, count(score) AS n, count(*) AS pages FROM m WHERE value IS NOT NULL GROUP BY ALL)
"""


@query(f"{_STATS} SELECT feature, value, metric, round(mean, 6) AS mean, round(std, 6) AS std, n, pages FROM stats")
def metadata_stats(spark, sf_dir):
    rows = rollup.by_feature(labelled(spark, sf_dir), ["language", "source"], ["quality", "chars"])
    return rows.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query(f"{_STATS} SELECT concat('score/avg_', feature, '_', metric) AS key, round(avg(mean), 6) AS value FROM stats GROUP BY feature, metric")
def macro_avg(spark, sf_dir):
    rows = rollup.by_feature(labelled(spark, sf_dir), ["language", "source"], ["quality", "chars"])
    return rollup.macro_average(rows).withColumn("value", F.round("value", 6))


@query(f"{_STATS} SELECT metric, round(avg(mean) FILTER (WHERE value IN ('French', 'Castillan')), 6) AS romance, round(avg(mean) FILTER (WHERE value NOT IN ('French', 'Castillan')), 6) AS other FROM stats WHERE feature = 'language' GROUP BY metric")
def romance_split(spark, sf_dir):
    rows = rollup.by_family(rollup.by_feature(labelled(spark, sf_dir), ["language", "source"], ["quality", "chars"]))
    return rows.select("metric", F.round("romance", 6).alias("romance"), F.round("other", 6).alias("other"))


@query("SELECT conv_id AS id, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1")
def last_wins(spark, sf_dir):
    texts = exports.last_texts(table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "id"), ["turn"])
    return texts.select("id", F.md5("text").alias("digest"))


@query("SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def page_text_export(spark, sf_dir):
    rows = exports.page_text_files(table(spark, sf_dir, "conversations").withColumnRenamed("turn", "idx"), ["conv_id"])
    return rows.select("conv_id", F.md5("value").alias("digest"))


@query("""
    SELECT c_custkey, concat_ws(chr(10), CASE WHEN c_nationkey % 2 = 0 THEN 'Keep abbreviations as written, do not expand them.' END,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'Keep original u/v and i/j distinctions as written.' WHEN 'MACHINERY' THEN 'Modernize u/v and i/j usage.' END) AS prompt FROM customer
""")
def prompt_conventions(spark, sf_dir):
    abbreviations = F.when(F.col("c_nationkey") % 2 == 0, "keep")
    uv = F.when(F.col("c_mktsegment") == "BUILDING", "original").when(F.col("c_mktsegment") == "MACHINERY", "modern")
    known = F.create_map(F.lit("abbreviations"), abbreviations, F.lit("uv_ij"), uv)
    return table(spark, sf_dir, "customer").select("c_custkey", T.prompt_block(known).alias("prompt"))


@query(f"SELECT doc_id, CAST(floor(idx / 40) AS BIGINT) AS chunk, count(*) AS n FROM ({LINES}) GROUP BY ALL")
def chunk40(spark, sf_dir):
    return order.chunks(document_lines(spark, sf_dir), ["doc_id"]).groupBy("doc_id", "chunk").agg(F.count("*").alias("n"))


_DENSITY = "SELECT doc_id, source, n_chars, CASE WHEN text = '' THEN 0 ELSE CAST(length(regexp_replace(text, '[^éèàùç]', '', 'g')) AS DOUBLE) / length(text) END AS density FROM documents"


@query(f"SELECT count(*) FILTER (WHERE density > 0) AS n_special, round(avg(1 + 2 * density), 9) AS mean, min(1 + 2 * density) AS least, max(1 + 2 * density) AS most FROM ({_DENSITY})")
def weights_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", T.density(F.col("text"), "éèàùç").alias("density"))
    return rollup.weight_summary(rollup.sample_weights(rows, alpha=2)).withColumn("mean", F.round("mean", 9))


# Each draw falls on the last row that begins at or before it, on the line of weights in the order of doc_id.
@query(f"""
    WITH w AS (SELECT doc_id, 1 + density AS weight FROM ({_DENSITY})),
      l AS (SELECT doc_id, weight, coalesce(sum(weight) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM w),
      d AS (SELECT ('0x' || substr(md5('42-' || i), 1, 13))::BIGINT / 4503599627370496.0 * (SELECT max(low + weight) FROM l) AS point FROM range(5000) t(i))
    SELECT doc_id, count(*) AS copies FROM d ASOF JOIN l ON d.point >= l.low GROUP BY doc_id
""")
def weighted_resample(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", T.density(F.col("text"), "éèàùç").alias("density"))
    return rollup.resampled(rollup.sample_weights(rows), "doc_id", 5000).select("doc_id", "copies")


@query(f"SELECT round(regr_slope(n_chars, density), 4) AS slope, round(regr_r2(n_chars, density), 9) AS r2, count(*) AS n FROM ({_DENSITY})")
def density_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("n_chars", T.density(F.col("text"), "éèàùç").alias("density"))
    return rollup.regression(rows, "density", "n_chars").select(F.round("slope", 4).alias("slope"), F.round("r2", 9).alias("r2"), "n")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def metadata_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(files.parsed(F.col("props")), F.lit("k")).alias("k"))


@query()
def wrap_1024(spark, sf_dir):
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.wrapped(F.col("text"))).alias("idx", "piece"))
    return pieces.select("doc_id", "idx", F.length("piece").alias("n"), F.md5("piece").alias("digest"))


@query("SELECT p_partkey, regexp_replace(p_name, '[^\\p{L}\\p{N}_-]', '_', 'g') AS file, regexp_replace(p_brand, '[ /-]', '_', 'g') AS metric FROM part")
def safe_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.file_name(F.col("p_name")).alias("file"), T.metric_name(F.col("p_brand")).alias("metric"))


# Pages made of the tables: an order is a page with one block, a line item a line of it. They are rendered and read again.
def alto_pages(spark, sf_dir) -> DataFrame:
    rows = page_boxes(spark, sf_dir).select(F.concat(F.lit("d"), F.col("page") % 7).alias("document"), F.concat(F.lit("p"), "page").alias("page"), "idx", "box", "flag")
    text = F.when(F.col("flag") != "N", F.concat(F.lit('é & "'), "idx", F.lit('" <b>')))
    lines = rows.select(
        "document", "page", F.lit(0).alias("zone"), F.col("idx").cast("long").alias("idx"), F.concat(F.lit("l"), "idx").alias("id"), "box", G.midline(F.col("box")).alias("baseline"),
        G.polygon(F.col("box")).cast(G.POINTS).alias("boundary"), text.alias("text"), F.lit(0.25).alias("confidence"), F.col("idx").alias("position"),
    )
    pages = rows.groupBy("document", "page").agg(F.concat("page", F.lit(".jpg")).alias("image")).select("document", "page", "image", F.lit(2500).alias("width"), F.lit(2100).alias("height"))
    blocks = rows.groupBy("document", "page").agg(F.max(F.when(F.col("flag") == "R", "NumberingZone").otherwise("MainZone")).alias("label"))
    whole = G.box(*[F.lit(v) for v in (0, 0, 2500, 2100)])
    blocks = blocks.select("document", "page", F.lit(0).alias("idx"), F.lit("b").alias("id"), "label", whole.alias("box"), F.lit(1).alias("position"))
    return alto.parsed_pages(out_alto.rendered(pages, blocks, lines))


_ALTO = f"""
    SELECT 'd' || page % 7 AS document, 'p' || page AS page, idx, x1, y1, x2, y2, CASE WHEN flag <> 'N' THEN 'é & "' || idx || '" <b>' END AS text,
      max(CASE WHEN flag = 'R' THEN 'NumberingZone' ELSE 'MainZone' END) OVER (PARTITION BY page) AS region, CAST(floor((y1 + y2) / 2) AS INT) AS m FROM ({BOXES})
"""


@query(f"""
    SELECT document, page, 'l' || idx AS id, region, x1, y1, x2, y2, x1 || ',' || m || ' ' || x2 || ',' || m AS baseline,
      x1 || ',' || y1 || ' ' || x2 || ',' || y1 || ' ' || x2 || ',' || y2 || ' ' || x1 || ',' || y2 AS boundary, text, CAST(0.25 AS DOUBLE) AS confidence FROM ({_ALTO}) WHERE region <> 'NumberingZone'
""")
def alto_lines(spark, sf_dir):
    flat_ = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(",", p["x"], p["y"])), " ").alias(c)
    return alto.lines(alto_pages(spark, sf_dir)).select("document", "page", "id", "region", "box.*", flat_("baseline"), flat_("boundary"), "text", "confidence")


@query(f"SELECT document, page, 'b' AS id, region AS label, 0 AS x1, 0 AS y1, 2500 AS x2, 2100 AS y2, CAST(count(*) AS INT) AS n_lines FROM ({_ALTO}) GROUP BY document, page, region")
def alto_zones(spark, sf_dir):
    return alto.seen_zones(alto_pages(spark, sf_dir)).select("document", "page", "id", "label", "box.*", "n_lines")


@query(f"SELECT document, page, string_agg(text, ' ' ORDER BY idx) AS text FROM ({_ALTO}) WHERE text IS NOT NULL GROUP BY document, page")
def alto_page_texts(spark, sf_dir):
    return alto.page_texts(alto.lines(alto_pages(spark, sf_dir), ignored=()))


@query(f"SELECT document, page, coalesce(string_agg(text, ' ' ORDER BY idx), '') AS text FROM ({_ALTO}) GROUP BY document, page")
def alto_page_texts_or_none(spark, sf_dir):
    pages = alto_pages(spark, sf_dir)
    return alto.page_texts_of(pages.select("document", "page"), alto.lines(pages, ignored=()))


@query(f"SELECT document, page, string_agg(text, '|' ORDER BY floor(y1 / 10), x1, idx) AS texts FROM ({_ALTO}) WHERE text IS NOT NULL GROUP BY document, page")
def alto_texts_in_order(spark, sf_dir):
    rows = alto.texts_in_order(alto.lines(alto_pages(spark, sf_dir), ignored=()))
    return rows.select("document", "page", F.array_join("texts", "|").alias("texts"))


@query(f"SELECT document, page, CAST(idx - 1 AS BIGINT) AS idx, CAST(trunc(100 * x1 / 2500.0) AS INT) AS x1, CAST(trunc(100 * y1 / 2100.0) AS INT) AS y1, CAST(trunc(100 * x2 / 2500.0) AS INT) AS x2, CAST(trunc(100 * y2 / 2100.0) AS INT) AS y2 FROM ({_ALTO})")
def alto_score_boxes(spark, sf_dir):
    lines = alto.lines(alto_pages(spark, sf_dir), ignored=(), keep=("width", "height"))
    return flat(alto.score_boxes(lines).select("document", "page", "idx", "box"))


@query(f"SELECT document, page, '1 ' || string_agg(printf('%.6f %.6f', least(1.0, x / 2500.0), least(1.0, y / 2100.0)), ' ' ORDER BY k) AS value, idx - 1 AS idx FROM (SELECT document, page, idx, unnest([x1, x2, x2, x1]) AS x, unnest([y1, y1, y2, y2]) AS y, unnest([1, 2, 3, 4]) AS k FROM ({_ALTO})) GROUP BY document, page, idx")
def detector_polygons(spark, sf_dir):
    lines = alto.lines(alto_pages(spark, sf_dir), ignored=(), keep=("width", "height"))
    return exports.yolo_rows(lines, polygons=True).withColumn("idx", F.col("idx").cast("int"))


@query(f"SELECT CASE hash WHEN 0 THEN 'val' ELSE 'train' END AS split, count(DISTINCT page) AS images, CAST(count(*) AS BIGINT) AS lines FROM (SELECT *, CASE WHEN document = 'd3' THEN 0 ELSE 1 END AS hash FROM ({_ALTO})) WHERE document <> 'd5' GROUP BY split")
def detector_split_counts(spark, sf_dir):
    split = F.when(F.col("document") == "d3", "val").otherwise("train")
    named = {"split": split, "image": F.when(F.col("document") != "d5", F.col("image"))}
    lines = alto.lines(alto_pages(spark, sf_dir).withColumns(named), ignored=(), keep=("width", "height", *named))
    return exports.detector_counts(exports.detector_set(exports.yolo_rows(lines, keep=tuple(named))))


@query(f"""
    WITH b AS (SELECT * FROM ({BOXES}) WHERE flag <> 'N'), gone AS (
      SELECT DISTINCT a.page, CASE WHEN (a.x2 - a.x1) * (a.y2 - a.y1) < (b.x2 - b.x1) * (b.y2 - b.y1) THEN a.idx ELSE b.idx END AS idx
      FROM b a JOIN b ON a.page = b.page AND a.idx < b.idx WHERE {IOU} > 0.5),
    k AS (SELECT *, (x1 + x2) / 2.0 AS cx FROM b WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.page = b.page AND g.idx = b.idx)),
    g AS (SELECT *, CASE WHEN cx - lag(cx) OVER (PARTITION BY page ORDER BY cx, idx) <= 300 THEN 0 ELSE 1 END AS fresh FROM k),
    c AS (SELECT *, sum(fresh) OVER (PARTITION BY page ORDER BY cx, idx ROWS UNBOUNDED PRECEDING) AS col FROM g)
    SELECT page, idx, 'block_' || (row_number() OVER (PARTITION BY page ORDER BY col, y1, cx, idx) - 1) AS id FROM c
""")
def blocks_of_detections(spark, sf_dir):
    found = boxes.named(page_boxes(spark, sf_dir).withColumn("class_id", F.when(F.col("flag") == "N", 0).otherwise(1)), {0: "NumberingZone", 1: "MainZone"})
    return out_alto.from_detections(found, ["page"]).select("page", "idx", "id")


@query(f"SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY idx) - 1 AS INT) AS idx, x1 FROM ({BOXES}) WHERE flag <> 'A'")
def zones_only(spark, sf_dir):
    found = page_boxes(spark, sf_dir).withColumn("label", F.when(F.col("flag") == "A", "ZoneLine").otherwise(F.concat("flag", F.lit("Zone"))))
    return boxes.zones_only(found, ["page"]).select("page", "idx", F.col("box.x1").alias("x1"))


@query(f"SELECT page, median(x2 - x1) AS median_height FROM ({BOXES}) GROUP BY page")
def median_height(spark, sf_dir):
    turned = G.box(F.col("box.y1"), F.col("box.x1"), F.col("box.y2"), F.col("box.x2"))
    return order.median_height(page_boxes(spark, sf_dir).withColumn("box", turned), ["page"])


@query(f"SELECT page, idx, x1 || ',' || m || ' ' || x2 || ',' || m AS baseline, CASE WHEN flag = 'R' THEN 3 ELSE 4 END AS corners FROM (SELECT *, CAST(floor((y1 + y2) / 2) AS INT) AS m FROM ({BOXES}))")
def detected_lines(spark, sf_dir):
    mask = F.when(F.col("flag") == "R", F.slice(G.polygon(F.col("box")).cast(G.POINTS), 1, 3))
    rows = page_boxes(spark, sf_dir).select("page", "idx", G.detected_line(F.col("box"), mask).alias("l"))
    baseline = F.array_join(F.transform("l.baseline", lambda p: F.concat_ws(",", p["x"], p["y"])), " ")
    return rows.select("page", "idx", baseline.alias("baseline"), F.size("l.boundary").alias("corners"))


@query(f"SELECT page, idx, x1 || ',' || (y1 - 10) || ' ' || x2 || ',' || (y1 - 10) || ' ' || x2 || ',' || (y1 + 10) || ' ' || x1 || ',' || (y1 + 10) AS boundary FROM ({BOXES})")
def boundaries_of_baselines(spark, sf_dir):
    baseline = F.array(*[F.struct(F.col(f"box.{x}").alias("x"), F.col("box.y1").alias("y")) for x in ("x1", "x2")])
    rows = page_boxes(spark, sf_dir).withColumn("b", G.around(baseline.cast(G.POINTS)))
    return rows.select("page", "idx", F.array_join(F.transform("b", lambda p: F.concat_ws(",", p["x"], p["y"])), " ").alias("boundary"))


@query(f"SELECT page, idx, x1 || ',' || y1 || ' ' || x2 || ',' || y2 AS pairs, 2 AS strict, CAST(x1 + 0.5 AS DOUBLE) AS first_x, CAST(4 AS INT) AS n, flag = 'R' AS degenerate FROM ({BOXES})")
def points_of_texts(spark, sf_dir):
    b, plain = F.col("box"), lambda *parts: F.concat_ws("", *parts)
    comma = plain(b["x1"], F.lit(".9,"), b["y1"], F.lit("  x,y "), b["x2"], F.lit(","), b["y2"])
    mixed = plain(b["x1"], F.lit(".5,"), b["y1"], F.lit(" "), b["x2"], F.lit(" "), b["y2"], F.lit(",7 8 9"))
    twice = F.array(*[F.struct(F.when(F.col("flag") == "R", b["x1"]).otherwise(b["x1"] + i).alias("x"), b["y1"].alias("y")) for i in (0, 1)]).cast(G.POINTS)
    rows = page_boxes(spark, sf_dir).select("page", "idx", G.points(comma).alias("p"), G.points(plain(b["x1"], F.lit(" "), b["y1"], F.lit(" "), b["x2"], F.lit(" "), b["y2"], F.lit(" 5")), strict=True).alias("s"), G.float_points(mixed).alias("f"), G.degenerate(twice).alias("degenerate"))
    pairs = F.array_join(F.transform("p", lambda p: F.concat_ws(",", p["x"], p["y"])), " ")
    return rows.select("page", "idx", pairs.alias("pairs"), F.size("s").alias("strict"), F.col("f")[0]["x"].alias("first_x"), (F.size("f") + 1).alias("n"), "degenerate")


@query(f"SELECT conv_id, CAST(sum(CASE WHEN {_CLEANED.replace('html', 'text')} <> text THEN 1 ELSE 0 END) AS BIGINT) AS modified FROM conversations GROUP BY conv_id")
def cleaned_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select(F.lit("d").alias("document"), F.col("conv_id").alias("page"), "text")
    return tasks.cleaned_counts(lines).select(F.col("page").alias("conv_id"), "modified")


@query("""
    SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN 'near/' || d.doc_id END, CASE WHEN d.doc_id % 2 = 0 THEN 'apart/' || d.doc_id END,
      CASE WHEN d.doc_id % 5 = 0 THEN 'root/' || d.doc_id END) AS xml FROM documents d
""")
def pages_beside_images(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("stem"))
    at = lambda n, name, folder: docs.filter(F.col("doc_id") % n == 0).select(folder.alias("folder"), "stem", F.concat(F.lit(f"{name}/"), "stem").alias("path"))
    near, apart = at(3, "near", F.col("folder")), at(2, "apart", F.col("folder")).unionByName(at(5, "root", F.lit(None).cast("string")))
    return files.paired_xml(docs, near, apart).select("doc_id", "xml")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'own/' || doc_id || '.jpg' WHEN doc_id % 2 = 0 THEN 'own/' || doc_id || '.tif' WHEN doc_id % 5 = 0 THEN 'root/' || doc_id || '.png' END AS image FROM documents")
def images_of_pages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("stem"))
    at = lambda n, name, ending, folder: docs.filter(F.col("doc_id") % n == 0).select(folder.alias("folder"), "stem", F.lit(ending).alias("ending"), F.concat(F.lit(f"{name}/"), "stem", F.lit(ending)).alias("path"))
    images = at(3, "own", ".jpg", F.col("folder")).unionByName(at(2, "own", ".tif", F.col("folder"))).unionByName(at(5, "root", ".png", F.lit(None).cast("string"))).unionByName(at(7, "own", ".gif", F.col("folder")))
    return files.paired(docs, images).select("doc_id", "image")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' END AS split FROM documents WHERE doc_id % 5 < 3")
def named_splits(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("train", "Valid", "testing", "dev", "other")])
    docs = table(spark, sf_dir, "documents").select("doc_id", names[(F.col("doc_id") % 5).cast("int")].alias("folder"))
    return files.splits(docs).select("doc_id", "split")


@query(r"""
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'average' ELSE 'value' END AS kind, CASE WHEN p_size % 2 = 0 THEN 'a_' || p_size ELSE 'f' || p_size END AS feature,
      CASE WHEN p_size % 2 = 1 THEN regexp_replace(p_type, '[ /-]', '_', 'g') END AS value, 'cer' AS metric, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_brand || '/' || p_name END AS name,
      CASE WHEN p_size % 3 <> 1 THEN true ELSE false END AS supported FROM part
""")
def keys_and_names(spark, sf_dir):
    size = F.col("p_size").cast("string")
    key = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("score/avg_a_"), size, F.lit("_cer"))).otherwise(F.concat(F.lit("by_f"), size, F.lit("/"), T.metric_name(F.col("p_type")), F.lit("/cer")))
    model = F.when(F.col("p_size") % 3 == 0, "qwen2_5_vl_chat").when(F.col("p_size") % 3 == 2, "blip").otherwise(F.concat(F.lit("x"), size))
    name = T.display_name(F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).otherwise(""), F.col("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", T.metric_parts(key).alias("k"), name.alias("name"), T.supported(model, ("qwen2.5-vl", "blip")).alias("supported"))
    return rows.select("p_partkey", "k.*", "name", "supported")


@query("SELECT p_partkey, regexp_replace(p_brand, '[^\\p{L}\\p{N}_-]', '_', 'g') || printf('_line_%05d', row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)) AS file FROM part")
def numbered_names(spark, sf_dir):
    return exports.numbered_names(table(spark, sf_dir, "part"), F.col("p_brand"), ["p_partkey"]).select("p_partkey", "file")


_SETS = {"accents": "éèàùç", "stops": ".,"}


@query(" UNION ALL ".join(f"""
    SELECT '{s}' AS "set", '{m}' AS metric, round(regr_slope({y}, x), 4) AS slope, round(regr_r2({y}, x), 9) AS r2, count(*) AS n
    FROM (SELECT n_chars, doc_id, CASE WHEN text = '' THEN 0 ELSE CAST(length(regexp_replace(text, '[^{c}]', '', 'g')) AS DOUBLE) / length(text) END AS x FROM documents)
""" for s, c in _SETS.items() for m, y in (("cer", "n_chars"), ("wer", "doc_id"))))
def density_study(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("document"), F.col("doc_id").alias("page"), F.col("n_chars").alias("cer"), F.col("doc_id").alias("wer"), "text")
    texts = docs.select(F.when(F.col("page") % 2 == 0, F.col("document")).alias("document"), "page", "text")  # others are found in the root
    rows = reports.with_densities(reports.scored_texts(docs.drop("text"), texts), _SETS)
    study = reports.density_study(rows, tuple(_SETS))
    return study.select("set", "metric", F.round("slope", 4).alias("slope"), F.round("r2", 9).alias("r2"), "n")


@query("SELECT " + ", ".join(f"CAST(max(n) FILTER (WHERE lang = '{x}') AS VARCHAR) AS \"total/{x}\"" for x in ("de", "en", "es", "fr")) + " FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def results_row(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").filter("lang is not null").groupBy("lang").count()
    rows = counts.select(F.concat(F.lit("total/"), "lang").alias("key"), F.col("count").cast("string").alias("value"))
    return reports.results_row(rows.unionByName(rows.withColumn("key", F.concat(F.lit("zonemap/"), "key"))))


@query("SELECT d.source AS document, d.n, CASE WHEN d.source <> (SELECT min(source) FROM documents) THEN 'Latin' END AS language FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source) d")
def metadata_of_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").filter("source is not null").groupBy(F.col("source").alias("document")).agg(F.count("*").alias("n"))
    first = documents.agg(F.min("document").alias("document"))
    meta = documents.join(first, "document", "left_anti").select("document", F.create_map(F.lit("language"), F.lit("Latin"), F.lit("conventions"), F.lit("x")).alias("metadata"))
    rows = reports.with_metadata(documents, meta)
    return rows.select("document", "n", F.when(F.size("metadata") == 1, F.element_at("metadata", "language")).alias("language"))


@query(f"SELECT round(sum(word_edits) / sum(words), 9) AS wer, CAST(sum(found_words) AS BIGINT) AS total_words FROM ({SQL['wer_pairs']})")
def wer_corpus(spark, sf_dir):
    rates = errors.rates(errors.with_edits(turn_pairs(spark, sf_dir)))
    return rates.select(F.round("wer", 9).alias("wer"), "total_words")


@query(f"SELECT z.page, z.idx, CAST(coalesce((SELECT min(l.y1) FROM ({BOXES}) l WHERE l.page = z.page AND l.idx > 2 AND l.idx % 2 + 1 = z.idx), z.y1) AS INT) AS first_y FROM ({BOXES}) z WHERE z.idx <= 2")
def zone_first_lines(spark, sf_dir):
    rows = page_boxes(spark, sf_dir)
    lines = rows.filter("idx > 2").select("page", (F.col("idx") % 2 + 1).alias("zone"), F.col("box.y1").alias("y"))
    return order.with_first_y(rows.filter("idx <= 2"), lines, ["page"]).select("page", "idx", "first_y")


@query(f"SELECT page, 'l' || idx AS id, CASE WHEN flag = 'R' THEN 'r' || idx ELSE '' END AS text, CAST(CASE WHEN flag = 'R' THEN 0.5 ELSE 0 END AS DOUBLE) AS confidence FROM ({BOXES})")
def recognised_lines(spark, sf_dir):
    lines = page_boxes(spark, sf_dir).select("page", "idx", "flag", F.concat(F.lit("l"), "idx").alias("id"), F.lit("old").alias("text"))
    results = lines.filter("flag <> 'N'").select("page", "id", F.when(F.col("flag") == "R", F.concat(F.lit("r"), "idx")).otherwise("").alias("text"), F.lit(0.5).alias("confidence"))
    return out_alto.recognised(lines, results, ["page"]).select("page", "id", "text", F.col("confidence").cast("double").alias("confidence"))


@query(f"SELECT page, 'l' || idx AS id, CASE WHEN idx <= 3 THEN 't' || idx ELSE '' END AS text FROM ({BOXES})")
def recognised_in_order(spark, sf_dir):
    lines = page_boxes(spark, sf_dir).select("page", F.col("idx").cast("long").alias("idx"), F.concat(F.lit("l"), "idx").alias("id"), F.lit("old").alias("text"))
    places = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("position")
    texts = lines.select("page").distinct().select("page", places).withColumn("text", F.concat(F.lit("t"), "position")).withColumn("confidence", F.lit(1.0))
    return out_alto.recognised_in_order(lines, texts, ["page"]).select("page", "id", "text")


@query(f"""
    WITH l AS (SELECT doc_id, idx, text FROM ({LINES}) WHERE regexp_matches(text, '\\S')), n AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1) / 40) AS BIGINT) AS chunk FROM l)
    SELECT doc_id, chunk, md5(string_agg(text, chr(10) ORDER BY idx)) AS digest FROM n GROUP BY doc_id, chunk
""")
def training_blocks(spark, sf_dir):
    lines = document_lines(spark, sf_dir).select(F.lit("d").alias("document"), F.col("doc_id").alias("page"), "idx", "text")
    return tasks.training_blocks(lines).select(F.col("page").alias("doc_id"), "chunk", F.md5("text").alias("digest"))


# Boxes with several confidences, found in their order: a curve of several points.
_FOUND = f"""
    b AS ({BOXES}), f AS (SELECT *, (x1 % 4) / 4.0 AS confidence, row_number() OVER (PARTITION BY page ORDER BY (x1 % 4) DESC, idx) AS k FROM b WHERE idx % 2 = 1),
      m AS (SELECT a.page, a.k, a.idx, a.confidence, list({{'iou': {IOU}, 'idx': b.idx}} ORDER BY {IOU} DESC, b.idx) AS near FROM f a JOIN b ON a.page = b.page AND b.idx % 2 = 0 GROUP BY ALL),
      th AS (SELECT round(0.5 + 0.05 * i, 2)::DOUBLE AS threshold FROM range(10) t(i)),
      s AS (SELECT DISTINCT m.page, th.threshold, 0 AS k, CAST([] AS INT[]) AS used, 0 AS hit, 0 AS idx, 0.0::DOUBLE AS confidence FROM m, th UNION ALL
        SELECT page, threshold, k, CASE WHEN best.iou >= threshold THEN list_append(used, best.idx) ELSE used END, CASE WHEN best.iou >= threshold THEN 1 ELSE 0 END, idx, confidence FROM (
          SELECT s.page, s.threshold, m.k, m.idx, m.confidence::DOUBLE AS confidence, s.used, list_filter(m.near, lambda x: NOT list_contains(s.used, x.idx))[1] AS best FROM s JOIN m ON m.page = s.page AND m.k = s.k + 1)),
      h AS (SELECT page % 20 AS document, page, threshold, idx, confidence, hit FROM s WHERE k > 0)
"""


def _found_boxes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(hits of boxes with odd numbers on those with even ones, true boxes), with a document for each twenty pages."""
    rows = page_boxes(spark, sf_dir).withColumn("document", F.col("page") % 20)
    truth = rows.filter("idx % 2 = 0").select("document", "page", "idx", "box")
    found = rows.filter("idx % 2 = 1").select("document", "page", F.col("idx").cast("long").alias("idx"), "box", (F.col("box.x1") % 4 / 4.0).alias("confidence"))
    return paths.written(detection.hits(truth, found, ["document", "page"]), "hits"), truth


@query(f"""
    WITH RECURSIVE {_FOUND}, l AS (SELECT threshold, confidence, sum(hit) AS tp, count(*) AS n FROM h GROUP BY ALL), t AS (SELECT count(*) AS total FROM b WHERE idx % 2 = 0),
      c AS (SELECT threshold, confidence, sum(tp) OVER w / sum(n) OVER w AS p, sum(tp) OVER w / total AS r FROM l, t WINDOW w AS (PARTITION BY threshold ORDER BY confidence DESC)),
      e AS (SELECT threshold, confidence, p, r, max(p) OVER (PARTITION BY threshold ORDER BY confidence ROWS UNBOUNDED PRECEDING) AS best, r - coalesce(lag(r) OVER (PARTITION BY threshold ORDER BY confidence DESC), 0) AS step FROM c)
    SELECT threshold, round(sum(best * step), 9) AS ap, round(min_by(p, confidence), 9) AS precision, round(max(r), 9) AS recall FROM e GROUP BY threshold
""")
def map_curve(spark, sf_dir):
    curve = detection.average_precision(*_found_boxes(spark, sf_dir))
    return curve.select("threshold", *[F.round(c, 9).alias(c) for c in ("ap", "precision", "recall")])


# The same by document, and means of the curve that has a point for each box; the mean of documents counts each once.
@query(f"""
    WITH RECURSIVE {_FOUND}, t AS (SELECT page % 20 AS document, count(*) AS total FROM b WHERE idx % 2 = 0 GROUP BY 1),
      l AS (SELECT document, threshold, confidence, sum(hit) AS tp, count(*) AS n FROM h GROUP BY ALL),
      c AS (SELECT document, threshold, confidence, sum(tp) OVER w / sum(n) OVER w AS p, sum(tp) OVER w / total AS r FROM l JOIN t USING (document) WINDOW w AS (PARTITION BY document, threshold ORDER BY confidence DESC)),
      e AS (SELECT document, threshold, max(p) OVER (PARTITION BY document, threshold ORDER BY confidence ROWS UNBOUNDED PRECEDING) * (r - coalesce(lag(r) OVER (PARTITION BY document, threshold ORDER BY confidence DESC), 0)) AS area FROM c),
      a AS (SELECT document, threshold, sum(area) AS ap FROM e GROUP BY ALL),
      q AS (SELECT document, sum(hit) OVER w / count(*) OVER w AS p, sum(hit) OVER w / total AS r FROM h JOIN t USING (document) WHERE threshold = 0.75 WINDOW w AS (PARTITION BY document ORDER BY confidence DESC, page, idx ROWS UNBOUNDED PRECEDING)),
      k AS (SELECT document, 'dataset_test/map50-95' AS key, avg(ap) AS value FROM a GROUP BY document UNION ALL SELECT document, 'dataset_test/map50', ap FROM a WHERE threshold = 0.5 UNION ALL
        SELECT document, 'dataset_test/map75', ap FROM a WHERE threshold = 0.75 UNION ALL SELECT document, 'dataset_test/precision', avg(p) FROM q GROUP BY document UNION ALL SELECT document, 'dataset_test/recall', avg(r) FROM q GROUP BY document)
    SELECT key, round(avg(value), 9) AS value, count(*) AS documents FROM k GROUP BY key
""")
def dataset_scores(spark, sf_dir):
    hits, truth = _found_boxes(spark, sf_dir)
    each = detection.dataset_scores(hits, truth, ["document", "page"], ["document"])
    counts = each.groupBy("key").agg(F.count("*").alias("documents"))
    return rollup.over_documents(each).join(counts, "key").select("key", F.round("value", 9).alias("value"), "documents")


# A conversation is a document, its turns pages: rates of each, and their mean, in which each counts once.
@query(f"""
    WITH r AS (SELECT conv_id, sum(levenshtein(truth_code, found_code)) / sum(length(truth)) AS cer, sum(length(found)) AS chars FROM ({_PAIRS}) GROUP BY conv_id HAVING sum(length(truth)) > 0)
    SELECT 'score/cer' AS key, round(avg(cer), 9) AS value FROM r UNION ALL SELECT 'total/total_chars', CAST(sum(chars) AS DOUBLE) FROM r
""")
def document_means(spark, sf_dir):
    rates = errors.rates(errors.with_edits(turn_pairs(spark, sf_dir)), ["conv_id"]).filter("cer is not null")
    each = rollup.long_form(rates.select("conv_id", F.col("cer").alias("score/cer"), F.col("total_chars").cast("double").alias("total/total_chars")), ["conv_id"], ["score/cer", "total/total_chars"])
    return rollup.over_documents(each).select("key", F.round("value", 9).alias("value"))


# A source is a folder of images, a document one of them. Three stubs: two blocks, the lower found first and one twice; two lines in each; texts.
@query("""
    SELECT coalesce(source, '') AS document, 'p' || doc_id AS page, CAST(k // 2 AS INT) AS zone, 'block_' || (k // 2) AS zone_id, 'MainZone' AS region, 'line_' || k AS id,
      10 AS x1, CAST(CASE WHEN k < 2 THEN 10 + 70 * k ELSE 160 + 65 * (k - 2) END AS INT) AS y1, 390 AS x2, CAST(CASE WHEN k < 2 THEN 80 + 70 * k ELSE 225 + 65 * (k - 2) END AS INT) AS y2, 'w line_' || k AS text
    FROM documents, range(4) t(k)
""")
def chained_prediction(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("document"), F.concat(F.lit("p"), "doc_id").alias("page"))
    images = names.withColumn("image", F.concat(F.lit("/images/"), "page", F.lit(".jpg")))
    boxes_ = [["MainZone", 10, 160, 390, 290], ["MainZone", 10, 10, 390, 150], ["MainZone", 12, 12, 390, 150], ["NumberingZone", 0, 0, 9, 9]]
    parsed = lambda rows: paths.written(alto.parsed_pages(rows), "pages")
    layout = parsed(tasks.predict_layout(images, "StubLayout", {"width": 400, "height": 300, "boxes": boxes_}))
    lines = parsed(tasks.predict_lines(layout, images, "StubLine", {"lines": 2}))
    pages = alto.parsed_pages(tasks.predict_pages(lines, names.limit(0), "StubHTR", {"text": "w {id}"}))
    return alto.lines(pages).select("document", "page", "zone", "zone_id", "region", "id", "box.*", "text")


# Texts of files, cleaned where they stand.
@query(f"""
    SELECT 'd' || page % 7 AS document, 'p' || page AS page, CAST(idx - 1 AS BIGINT) AS idx, nullif({_CLEANED.replace("html", "t")}, '') AS text
    FROM (SELECT page, idx, CASE WHEN flag <> 'N' THEN 'é & "' || idx || '" <b> [v]' ELSE '' END AS t FROM ({BOXES}))
""")
def cleaned_files(spark, sf_dir):
    rows = page_boxes(spark, sf_dir).select(F.concat(F.lit("d"), F.col("page") % 7).alias("document"), F.concat(F.lit("p"), "page").alias("page"), "idx", "box", "flag")
    text = F.when(F.col("flag") != "N", F.concat(F.lit('é & "'), "idx", F.lit('" <b> [v]'))).otherwise("")
    line = out_alto.element("TextLine", {"ID": F.col("idx")}, out_alto.element("String", {"CONTENT": text}))
    pages = rows.groupBy("document", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("l")))), lambda x: x["l"]), "").alias("l"))
    xml = F.concat(F.lit('<alto><Layout><Page WIDTH="9" HEIGHT="9"><PrintSpace><TextBlock ID="b">'), "l", F.lit("</TextBlock></PrintSpace></Page></Layout></alto>"))
    return alto.lines(alto.parsed_pages(out_alto.with_clean_texts(pages.select("document", "page", xml.alias("xml"))))).select("document", "page", "idx", "text")
