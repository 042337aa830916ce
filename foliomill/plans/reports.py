"""Reports of scores: tables by page, document, feature and corpus, error histograms, zone reports, studies of density and error.

All tables are DataFrames; write() lays them out as CSV folders. A result is a table of (key, value) until it becomes one wide row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.functions import charsets
from foliomill.functions import text as T
from foliomill.operators import boxes, detection, errors, rollup
from foliomill.sinks import exports, paths
from foliomill.sources import alto

PAGE = ["document", "page"]
RATES = ["cer", "wer", "char_accuracy", "word_accuracy"]

# Sections of the zone report, their rows in order, and what each says.
ZONE_REPORT = (
    ("--- Detection (area-based) ---", {
        "score": "Error % (lower=better)", **{k: "Fraction of GT area" for k in ("match", "miss", "false_alarm", "split", "merge", "multiple")}}),
    ("--- Detection (counts per doc) ---", {f"n_{k}": "Avg group count" for k in ("match", "miss", "false_alarm", "split", "merge", "multiple")}),
    ("--- Recognition (ZoneMapAltCnt) ---", {
        "char_precision": "Char-level", "char_recall": "Char-level", "char_f1": "Char-level",
        "word_precision": "Word-level", "word_recall": "Word-level", "word_f1": "Word-level F1"}),
)


def keyed(row: DataFrame, prefix: str = "", by: Sequence[str] = ()) -> DataFrame:
    """(by columns, key, value: text) of the columns of rows."""
    columns = [c for c in row.columns if c not in by]
    return rollup.long_form(row.select(*by, *[F.col(c).cast("string").alias(c) for c in columns]), list(by), columns, prefix)


def worst_keys(worst: DataFrame) -> DataFrame:
    """(key, value) of ranked pages: worst/top1_file, worst/top1_cer and so on."""
    top = lambda c: F.concat(F.lit("worst/top"), F.col("rank").cast("string"), F.lit(f"_{c}"))
    pairs = F.array(*[F.struct(top(c).alias("key"), F.col(c).cast("string").alias("value")) for c in ("file", "cer")])
    return worst.select(F.inline(pairs))


def metadata_keys(stats: DataFrame) -> DataFrame:
    """(key, value) of rollup.by_feature(): by_<feature>/<value>/<metric> of each mean, averages over a feature's values, and
    those over the two families of languages."""
    key = F.concat(F.lit("by_"), "feature", F.lit("/"), T.metric_name(F.col("value")), F.lit("/"), "metric")
    means = stats.filter("mean is not null").select(key.alias("key"), F.col("mean").alias("value"))
    families = rollup.by_family(stats)
    each = F.array(*[F.struct(F.concat(F.lit(f"score/avg_{name}_"), "metric").alias("key"), F.col(c).alias("value")) for c, name in (("romance", "romances"), ("other", "nonromances"))])
    families = families.select(F.inline(each)).filter("value is not null")
    rows = reduce(DataFrame.unionByName, [means, rollup.macro_average(stats), families])
    return rows.select("key", F.col("value").cast("string").alias("value"))


def results_row(metrics: DataFrame, *, most_keys: int = 5000) -> DataFrame:
    """One wide row of (key, value), keys in order, without zonemap/ and analysis/ keys. More than most_keys, which a feature with a value for
    each document would give, raise ValueError: name the features that are to be scored."""
    rows = metrics.filter(~F.col("key").startswith("zonemap/") & ~F.col("key").startswith("analysis/"))
    keys = sorted(r.key for r in rows.select("key").distinct().limit(most_keys + 1).collect())
    if len(keys) > most_keys:
        raise ValueError(f"over {most_keys} keys of metrics; name the features to score by")
    return rows.groupBy().pivot("key", keys).agg(F.first("value", ignorenulls=True)) if keys else rows.select()


def shown(metrics: DataFrame) -> DataFrame:
    """(key, value) for a reader: sorted, without analysis/ keys, numbers to four places."""
    number = F.col("value").try_cast("double")
    value = F.when(number.isNotNull() & F.col("value").contains("."), F.round(number, 4).cast("string")).otherwise(F.col("value"))
    return metrics.filter(~F.col("key").startswith("analysis/")).select("key", value.alias("value")).orderBy("key")


def zone_report(metrics: DataFrame, *, recognition: bool = True) -> DataFrame:
    """(metric, value, description) of the zonemap/ keys of metrics (key, value), section by section; the last section only with
    recognition."""
    rows = []
    for title, lines in ZONE_REPORT if recognition else ZONE_REPORT[:-1]:
        rows += [(title, "")] + [(f"zonemap/{k}", d) for k, d in lines.items()]
    spine = metrics.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, metric string, description string")
    found = spine.join(metrics.filter(F.col("key").startswith("zonemap/")), spine["metric"] == metrics["key"], "left")
    return found.orderBy("n").select("metric", F.coalesce("value", F.lit("")).alias("value"), "description")


def by_document(each: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """scores_per_document: document, pages and a column for each of keys, from each (document, key, value) and pages (document, ...)."""
    wide = each.groupBy("document").pivot("key", list(keys)).agg(F.first("value", ignorenulls=True))
    return pages.groupBy("document").agg(F.count("*").alias("pages")).join(wide, "document", "left")


def over_all(each: DataFrame) -> DataFrame:
    """(key, value: text) over documents: see rollup.over_documents()."""
    return rollup.over_documents(each).select("key", F.col("value").cast("string").alias("value"))


def zone_keys(stats: DataFrame) -> DataFrame:
    """(document, key, value) of the zone scores of each document, from page statistics."""
    zones = detection.zone_map_scores(stats, ["document"])
    zones = zones.withColumnsRenamed({c: c.removeprefix("share_") for c in zones.columns})
    names = [c for c in zones.columns if c != "document"]
    return rollup.long_form(zones.select("document", *[F.col(c).cast("double").alias(c) for c in names]), ["document"], names, "zonemap/")


def feature_tables(metrics: DataFrame) -> DataFrame:
    """(feature, value, cer, wer) of the by_<feature>/<value>/ keys, in order: what a reader sees of scores by feature."""
    rows = metrics.filter(F.col("key").startswith("by_")).select(T.metric_parts(F.col("key")).alias("p"), F.col("value").try_cast("double").alias("score"))
    rows = rows.select(F.col("p").getField("feature").alias("feature"), F.col("p").getField("value").alias("value"), F.col("p").getField("metric").alias("metric"), "score")
    wide = rows.groupBy("feature", "value").pivot("metric", ["cer", "wer"]).agg(F.first("score"))
    return wide.select("feature", "value", F.round("cer", 4).alias("cer"), F.round("wer", 4).alias("wer")).orderBy("feature", "value")


def histograms(operations: DataFrame, name: str) -> dict[str, DataFrame]:
    """<name>_substitutions, _insertions and _deletions: (symbol, count), the most frequent first."""
    symbol = F.when(F.col("operation") == "substitution", F.concat("truth", F.lit(" -> "), "found")).otherwise(F.concat("truth", "found"))
    rows = operations.select("operation", symbol.alias("symbol"), F.col("n").alias("count"))
    kinds = ("substitution", "insertion", "deletion")
    return {f"{name}_{k}s": rows.filter(F.col("operation") == k).drop("operation").orderBy(F.desc("count"), "symbol") for k in kinds}


def with_metadata(documents: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """documents with a column metadata (map), without conventions; null for documents that have none."""
    if metadata is None:
        return documents
    own = metadata.select("document", F.map_filter("metadata", lambda k, _: k != "conventions").alias("metadata"))
    return documents.join(own, "document", "left")


def features(documents: DataFrame, *, most: int = 100) -> list[str]:
    """Names in the metadata of documents: those of the corpus's own description. More than most raise ValueError."""
    found = sorted(r.k for r in documents.select(F.explode(F.map_keys("metadata")).alias("k")).distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"over {most} names in metadata; name the features to score by")
    return found


KINDS = ("insertion", "deletion", "substitution")
#: Keys of a document's scores, besides those of zones.
TEXT_KEYS = (
    "score/cer", "score/wer", "accuracy/char_accuracy", "accuracy/word_accuracy", "total/total_chars", "total/total_words",
    *(f"detailed/{level}_{k}s" for level in ("char", "word") for k in KINDS), "competition/cer", "competition/wer", "competition/matched_lines",
)
ZONE_KEYS = tuple(f"zonemap/{k}" for _, lines in ZONE_REPORT for k in lines)
BOX_KEYS = tuple(f"dataset_test/{k}" for k in ("map50-95", "map50", "map75", "precision", "recall"))


def text_report(truth: DataFrame, found: DataFrame, metadata: DataFrame | None = None, *, by: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Transcription scores of pages read by read_pages(): scores_all_pages, scores_per_document (all keys, with metadata), scores_by_<feature>,
    metrics (key, value), results (one wide row), results_zonemap, and histograms of errors in words and characters.

    Pages that one side lacks are left out. A document is scored over its pages together; metrics are means of documents, each
    counting once, but for total/ keys, which are sums, and worst/ keys, which are of all pages. by: names of the metadata that
    documents are grouped by, else all. What several tables are made of (pairs with their distances, operations, areas) is
    written once.
    """
    both = truth.select(*PAGE).distinct().join(found.select(*PAGE).distinct(), PAGE)
    a, b = (alto.lines(side, ignored=()).join(both, PAGE, "left_semi") for side in (truth, found))
    edited = paths.written(errors.with_edits(errors.pairing_modes(a, b, PAGE)), "edited-pairs")
    pages = errors.page_scores(edited, PAGE)
    operations = {name: paths.written(errors.operations(edited, level=level, by="document"), "operations") for name, level in (("wer", "word"), ("cer", "character"))}

    rates = errors.rates(edited, ["document"])
    wide = rates.select(
        "document", F.col("cer").alias("score/cer"), F.col("wer").alias("score/wer"), F.col("char_accuracy").alias("accuracy/char_accuracy"),
        F.col("word_accuracy").alias("accuracy/word_accuracy"), *[F.col(f"total_{x}").cast("double").alias(f"total/total_{x}") for x in ("chars", "words")],
    )
    for level, name in (("char", "cer"), ("word", "wer")):
        counts = operations[name].groupBy("document").pivot("operation", list(KINDS)).agg(F.sum("n").cast("double"))
        wide = wide.join(counts.withColumnsRenamed({k: f"detailed/{level}_{k}s" for k in KINDS}), "document", "left")
    ranked = lambda x: x.filter(~T.blank(F.col("text"))).withColumn("at", boxes.position(boxes.in_rows(), PAGE))
    matched = errors.matched_lines(ranked(a), ranked(b), [*PAGE, "at"], by=["document"])
    wide = wide.join(matched.select("document", *[F.col(c).cast("double").alias(f"competition/{c}") for c in ("cer", "wer", "matched_lines")]), "document", "left")
    wide = wide.fillna(0.0, [*[k for k in TEXT_KEYS if k.startswith("detailed/")], "competition/matched_lines"])
    each = rollup.long_form(wide, ["document"], TEXT_KEYS)
    place = lambda x: alto.with_geometry(x.filter(F.coalesce(~F.col("region").isin(*alto.IGNORED_ZONES), F.lit(True))))
    each = paths.written(each.unionByName(zone_keys(detection.zone_map(place(a), place(b), PAGE))), "document-scores")

    name = F.when(F.col("document") == "", F.col("page")).otherwise(T.display_name(F.col("document"), F.col("page")))
    metrics = [over_all(each), worst_keys(errors.worst(pages, name=name))]
    documents = with_metadata(by_document(each, pages, [*TEXT_KEYS, *ZONE_KEYS]), metadata)
    out = {"scores_all_pages": pages, "scores_per_document": documents}
    if metadata is not None and (names := list(by) if by is not None else features(documents)):
        value = {n: F.element_at("metadata", n) for n in names}
        stats = rollup.by_feature(documents.select("pages", F.col("`score/cer`").alias("cer"), F.col("`score/wer`").alias("wer"), *[v.alias(n) for n, v in value.items()]), names, ["cer", "wer"])
        stats = paths.written(stats, "feature-scores")
        metrics.append(metadata_keys(stats))
        out |= {f"scores_by_{n}": stats.filter(F.col("feature") == n).drop("feature").orderBy("value", "metric") for n in names}
        out["scores_per_document"] = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c != "metadata"], *[v.alias(f"metadata/{n}") for n, v in value.items()])
    total = {n: x.groupBy("operation", "truth", "found").agg(F.sum("n").alias("n")) for n, x in operations.items()}
    out |= histograms(total["wer"], "wer") | histograms(total["cer"], "cer")
    out["metrics"] = paths.written(reduce(DataFrame.unionByName, metrics), "metrics")
    out["results_zonemap"] = zone_report(out["metrics"])
    out["results"] = results_row(out["metrics"])
    return out


def write(tables: Mapping[str, DataFrame], folder: str, *, flat: bool = False) -> None:
    """CSV folders of a report. A flat data set has scores_per_page; others have scores_all_pages, one folder of scores_per_page for
    each document, and the tables of documents and features."""
    for name, rows in tables.items():
        if name == "metrics" or (flat and name.startswith(("scores_per_document", "scores_by_"))):
            continue
        if name == "scores_all_pages":
            exports.write_csv(rows.drop("document") if flat else rows, f"{folder}/{'scores_per_page' if flat else name}.csv")
            if not flat:
                exports.write_csv(rows, f"{folder}/scores_per_page.csv", ["document"])
        else:
            exports.write_csv(rows, f"{folder}/{name}.csv")


def scored_texts(scores: DataFrame, texts: DataFrame) -> DataFrame:
    """scores (page, cer, wer and maybe document) with the page's true text, of texts (document, page, text), where document is
    null for pages of the root: that of the document, else of the root. Scores without a text are left out."""
    own = texts.filter("document is not null").select(F.col("document").alias("_document"), F.col("page").alias("_page"), F.col("text").alias("_own"))
    root = texts.filter("document is null").select(F.col("page").alias("_name"), F.col("text").alias("_root"))
    rows = scores if "document" in scores.columns else scores.withColumn("document", F.lit(None).cast("string"))
    rows = rows.join(own, (F.col("document") == F.col("_document")) & (F.col("page") == F.col("_page")), "left")
    rows = rows.join(root, F.col("page") == F.col("_name"), "left").withColumn("text", F.coalesce("_own", "_root"))
    return rows.filter("text is not null").select(*scores.columns, "text")


#: The sets whose densities are studied; the last is all of them.
DENSITIES = {
    "combining": charsets.COMBINING, "medieval": charsets.MEDIEVAL, "superscript": charsets.SUPERSCRIPT,
    "merged": (*charsets.COMBINING, *charsets.MEDIEVAL, *charsets.SUPERSCRIPT),
}


def with_densities(rows: DataFrame, sets: Mapping[str, Sequence[str]] = DENSITIES) -> DataFrame:
    """rows (with text) with text_len and density_<set>, without the text."""
    rows = rows.withColumn("text_len", F.length("text"))
    return rows.withColumns({f"density_{n}": T.density(F.col("text"), own) for n, own in sets.items()}).drop("text")


def density_study(rows: DataFrame, sets: Sequence[str] = tuple(DENSITIES), metrics: Sequence[str] = ("cer", "wer")) -> DataFrame:
    """(set, metric, slope, intercept, r2, p_value, n) of each metric on each density; those without variation are left out."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(s).alias("set"), F.lit(m).alias("metric"), F.col(f"density_{s}").alias("x"), F.col(m).cast("double").alias("y")) for s in sets for m in metrics
    ]))
    return rollup.regression(rows.select(pairs.alias("p")).select("p.*"), "x", "y", ["set", "metric"])
