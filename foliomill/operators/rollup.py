"""Scores by document, metadata feature and corpus; studies of density and error; weighted samples."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.sinks.paths import written

# Languages counted as Romance.
ROMANCE = ("Catalan", "French", "Italian", "Latin", "Occitan", "Venitian", "Aragonese", "Galician", "Portuguese", "Castillan")


def over_documents(metrics: DataFrame) -> DataFrame:
    """(key, value) over documents from (document, key, value): sums of total/ and analysis/ keys, else the mean of the
    documents that have the key, each counting once whatever its size. Nulls are left out."""
    summed = F.col("key").startswith("total/") | F.col("key").startswith("analysis/")
    rows = metrics.filter("value is not null").groupBy("key")
    return rows.agg(F.when(F.first(summed), F.sum("value")).otherwise(F.avg("value")).alias("value"))


def long_form(wide: DataFrame, key: Sequence[str], metrics: Sequence[str], prefix: str = "") -> DataFrame:
    """(key columns, key, value) from a column for each metric."""
    rows = wide.unpivot(list(key), list(metrics), "key", "value")
    return rows.withColumn("key", F.concat(F.lit(prefix), "key"))


def by_feature(documents: DataFrame, features: Sequence[str], metrics: Sequence[str], pages: str = "pages") -> DataFrame:
    """(feature, value, metric, mean, std, n, pages) over documents that have the feature. One exchange for all features."""
    rows = documents.select(pages, *metrics, F.explode(F.create_map(*[x for f in features for x in (F.lit(f), F.col(f).cast("string"))])).alias("feature", "value"))
    rows = rows.filter("value is not null").unpivot(["feature", "value", pages], list(metrics), "metric", "score")
    return rows.groupBy("feature", "value", "metric").agg(
        F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"), F.count("score").alias("n"), F.sum(pages).alias("pages")
    )


def macro_average(stats: DataFrame) -> DataFrame:
    """(key, value): for each feature and metric the mean of its values' means."""
    key = F.concat(F.lit("score/avg_"), "feature", F.lit("_"), F.translate("metric", " /-", "___"))
    return stats.groupBy(key.alias("key")).agg(F.avg("mean").alias("value"))


def by_family(stats: DataFrame, feature: str = "language", romance: Sequence[str] = ROMANCE) -> DataFrame:
    """(metric, romance, other): means of the languages' means in each family."""
    inside = F.col("value").isin(*romance)
    rows = stats.filter(F.col("feature") == feature).groupBy("metric")
    return rows.agg(F.avg(F.when(inside, F.col("mean"))).alias("romance"), F.avg(F.when(~inside, F.col("mean"))).alias("other"))


def regression(points: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, slope, intercept, r2, p_value, n) of y on x; groups without variation in x or y are left out."""
    rows = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.count("*").alias("n"),
        F.stddev_pop(x).alias("_x"), F.stddev_pop(y).alias("_y"),
    )
    rows = rows.filter("_x > 0 and _y > 0").drop("_x", "_y")

    @F.pandas_udf("double")
    def p_value(r2, n):
        return r2.combine(n, lambda a, b: two_sided(a, int(b)))

    return rows.withColumn("p_value", p_value("r2", F.col("n").cast("double")))


def two_sided(r2: float, n: int) -> float:
    """Probability of at least this r2 without any slope: the t distribution with n - 2 degrees of freedom."""
    if n <= 2:
        return float("nan")
    if r2 >= 1:
        return 0.0
    # the tail of t is an integral of (1 - s^2)^((n - 4) / 2) over the correlation s; with s = sin(a) it is smooth
    a = np.linspace(np.arcsin(np.sqrt(max(r2, 0.0))), np.pi / 2, 20001)
    full = np.linspace(0, np.pi / 2, 20001)
    part = lambda x: np.trapezoid(np.cos(x) ** (n - 3), x)
    return float(part(a) / part(full))


def sample_weights(samples: DataFrame, density: str = "density", alpha: float = 1.0) -> DataFrame:
    return samples.withColumn("weight", 1 + alpha * F.col(density))


def weight_summary(weighted: DataFrame, density: str = "density") -> DataFrame:
    return weighted.agg(
        F.count_if(F.col(density) > 0).alias("n_special"), F.avg("weight").alias("mean"), F.min("weight").alias("least"), F.max("weight").alias("most")
    )


def dealt(rows: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """rows with _part, as a written table: ranges of order, numbered along it."""
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")


def cumulated(rows: DataFrame, order: Sequence[str], value: str, name: str, *, parts: int | None = None) -> DataFrame:
    """rows with name: the sum of value over the rows before, by order. Each range of rows is summed by itself; what the
    ranges before have is one number for each."""
    placed = dealt(rows, order, parts)
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # ranges, not rows
    before = placed.groupBy("_part").agg(F.sum(value).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(along), F.lit(0.0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
    return out.drop("_part", "_before")


def numbered(rows: DataFrame, key: str, order: Sequence[str], name: str, *, parts: int | None = None) -> DataFrame:
    """rows with name: a row's number among those of its key, from 1, by order. A key's rows are numbered range by range, and go on from what
    the ranges before have, so a key may have most rows."""
    placed = dealt(rows, [key, *order], parts)
    counts = placed.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # ranges of a key
    # only a key that goes on from an earlier range has some before, one at most in each range
    before = counts.select(key, "_part", F.sum("_n").over(along).alias("_before")).filter("_before is not null")
    on = placed[key].eqNullSafe(F.col("_key")) & (placed["_part"] == F.col("_at"))
    out = placed.join(F.broadcast(before.withColumnsRenamed({key: "_key", "_part": "_at"})), on, "left")
    n = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) + F.coalesce("_before", F.lit(0))
    return out.withColumn(name, n).drop("_part", "_key", "_at", "_before")


def last_before(points: DataFrame, marks: DataFrame, at: str, key: str, *, parts: int | None = None) -> DataFrame:
    """points (at, ...) with key: that of the last of marks (at, key) at or before each; of marks at one place, the greatest key.

    An as-of merge: both are sorted together by ranges of at, the last mark is carried along each range, and from the
    ranges before as one key for each. No point meets more than its own mark. Points before all marks have a null key.
    """
    columns = [c for c in points.columns if c != at]
    own = points.select(at, F.lit(1).alias("_side"), F.lit(None).cast(dict(marks.dtypes)[key]).alias(key), F.struct(*columns).alias("_row"))
    rest = marks.select(at, F.lit(0).alias("_side"), key, F.lit(None).cast(dict(own.dtypes)["_row"]).alias("_row"))
    rows = dealt(own.unionByName(rest), [at], parts)
    ends = rows.filter("_side = 0").groupBy("_part").agg(F.max(F.struct(at, key)).alias("_end"))
    spine = rows.select("_part").distinct().join(ends, "_part", "left")
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # ranges, not rows
    before = spine.select("_part", F.last(F.col(f"_end.{key}"), ignorenulls=True).over(along).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy(at, "_side", key).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(F.broadcast(before), "_part").withColumn(key, F.coalesce(F.last(key, ignorenulls=True).over(inside), "_carried"))
    return rows.filter("_side = 1").select(at, key, "_row.*")


def draws(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """(draw, u): n points from 0 to below 1, the first 52 bits of the MD5 of seed and number."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string"))), 1, 13), 16, 10).cast("long")
    return spark.range(n).select(F.col("id").alias("draw"), (bits / F.lit(2.0**52)).alias("u"))


def resampled(weighted: DataFrame, key: str, n: int, *, seed: int = 42, parts: int | None = None) -> DataFrame:
    """weighted with copies: how many of n draws with replacement, by weight, fall on each row.

    Draws are seeded points on the line of cumulated weights, in the order of key, which has to be unique; each falls on the
    last row that begins at or before it (see last_before()), so work is that of sorting rows and draws. Rows of null, zero or negative
    weight are never drawn. parts: ranges that rows and draws are sorted by, else as many as there are shuffle partitions.
    """
    rows = cumulated(weighted.filter("weight > 0").select(key, F.col("weight").cast("double").alias("weight")), [key], "weight", "_at", parts=parts)
    rows = written(rows.select(key, "_at", "weight"), "weight-line")
    total = rows.agg(F.max(F.col("_at") + F.col("weight"))).first()[0] or 0.0
    points = draws(weighted.sparkSession, n, seed).select((F.col("u") * total).alias("_at"), "draw")
    hits = last_before(points, rows.select("_at", key), "_at", key, parts=parts).groupBy(key).agg(F.count("*").alias("copies"))
    return weighted.join(hits, key)
