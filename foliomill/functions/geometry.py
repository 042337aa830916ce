"""Geometry of boxes, points and lines as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS = "array<struct<x: int, y: int>>"


def whole(text: Column) -> Column:
    """The number of a text, cut towards zero; null where it is none."""
    return text.try_cast("double").cast("int")


FLOAT_POINTS = "array<struct<x: double, y: double>>"


def let(value: Column, of) -> Column:
    """of(value), with value worked out once however often of() names it: Spark shares no work inside lambdas."""
    return F.get(F.transform(F.array(value), of), 0)


def fixed(rows: DataFrame, *names: str) -> DataFrame:
    """rows whose columns of these names are worked out once: a filter on them would be pushed below what makes them, which so is made
    again for each time that the filter names them. A filter does not pass an explode that gives its columns."""
    whole = F.explode_outer(F.array(F.struct(*names))).alias("_fixed")
    rows = rows.select(*[c for c in rows.columns if c not in names], whole)
    return rows.select(*[c for c in rows.columns if c != "_fixed"], "_fixed.*")


def _evens(tokens: Column) -> Column:
    """0, 2, 4 and so on: where pairs of tokens begin; an odd tail begins none."""
    return F.when(F.size(tokens) >= 2, F.sequence(F.lit(0), F.size(tokens) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))


def _good(found: Column) -> Column:
    return F.filter(found, lambda p: p["x"].isNotNull() & p["y"].isNotNull())


def float_points(text: Column) -> Column:
    """Points with fractions, of "x,y x,y", "x y x y" or a mixture; an odd tail is dropped, and a pair with what is not a number."""
    tokens = F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s,]+", " "), " "), lambda t: t != "")
    pair = lambda t, i: F.struct(F.get(t, i).try_cast("double").alias("x"), F.get(t, i + 1).try_cast("double").alias("y"))
    return let(tokens, lambda t: _good(F.transform(_evens(t), lambda i: pair(t, i))))


def points(text: Column, *, strict: bool = False) -> Column:
    """Points of "x,y x,y" or "x y x y"; an odd tail is dropped, and a pair with what is not a number.

    strict: any such pair gives null for the whole.
    """

    def found(text: Column) -> Column:
        first, second = (lambda t: F.substring_index(t, ",", 1)), (lambda t: F.substring_index(F.substring_index(t, ",", 2), ",", -1))
        comma = F.transform(F.filter(F.split(text, " "), lambda t: t.contains(",")), lambda t: _pair(first(t), second(t)))
        pairs = let(F.split(text, " "), lambda tokens: F.transform(_evens(tokens), lambda i: _pair(F.get(tokens, i), F.get(tokens, i + 1))))
        return F.when(text.isNull() | (text == ""), F.array().cast(POINTS)).when(text.contains(","), comma).otherwise(pairs)

    every = let(F.trim(F.regexp_replace(text, r"\s+", " ")), found)
    if not strict:
        return _good(every)
    return let(every, lambda f: let(_good(f), lambda g: F.when(F.size(g) == F.size(f), g)))


def _pair(x: Column, y: Column) -> Column:
    return F.struct(x.try_cast("double").cast("int").alias("x"), y.try_cast("double").cast("int").alias("y"))


def corner(points: Column, axis: str, least: bool) -> Column:
    return (F.array_min if least else F.array_max)(F.transform(points, lambda p: p[axis]))


def bounds(points: Column) -> Column:
    """struct(x1, y1, x2, y2) around points; null where there are none."""
    each = [corner(points, a, least).alias(f"{a}{1 if least else 2}") for least in (True, False) for a in "xy"]
    return F.when(F.size(points) > 0, F.struct(*each))


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*[v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2), strict=True)])


def padded(b: Column, pad: int) -> Column:
    """Room above and below a baseline's bounds."""
    return F.when(b.isNotNull(), box(b["x1"], b["y1"] - pad, b["x2"], b["y2"] + pad))


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def overlap(a: Column, b: Column) -> Column:
    """Area that two boxes share."""
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.when((wide > 0) & (high > 0), wide * high).otherwise(F.lit(0) * wide)


def iou(a: Column, b: Column) -> Column:
    """Shared area over joint area; 0.0 where the joint area is none."""
    both = area(a) + area(b) - overlap(a, b)
    return F.when(both > 0, overlap(a, b) / both).otherwise(F.lit(0.0))


def link_strength(a: Column, b: Column) -> Column:
    """Sum of the squared shares of each box that lie in the other."""
    shared = overlap(a, b)
    share = lambda c: F.coalesce(F.try_divide(shared, area(c)), F.lit(0.0))
    return F.pow(share(a), 2) + F.pow(share(b), 2)


def on_grid(b: Column, width: Column, height: Column, scale: int = 100) -> Column:
    """The box on a grid of scale by scale, cut to whole numbers."""
    at = lambda v, size: (F.lit(scale) * v / size).cast("int")
    return box(at(b["x1"], width), at(b["y1"], height), at(b["x2"], width), at(b["y2"], height))


def polygon(b: Column) -> Column:
    """The four corners of a box."""
    corner = lambda x, y: F.struct(b[x].alias("x"), b[y].alias("y"))
    return F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"))


def midline(b: Column) -> Column:
    """A level baseline at half the height of a box."""
    y = F.floor((b["y1"] + b["y2"]) / 2).cast("int")
    return F.array(F.struct(b["x1"].alias("x"), y.alias("y")), F.struct(b["x2"].alias("x"), y.alias("y")))


def around(baseline: Column, pad: int = 10) -> Column:
    """A boundary for a baseline of two points and more: its bounds with pad above and below."""
    return F.when(F.size(baseline) >= 2, polygon(padded(bounds(baseline), pad)).cast(POINTS))


def detected_line(b: Column, mask: Column) -> Column:
    """struct(id, baseline, boundary) of a detection: the level middle of its box, and its mask, or its box where it has none.

    The id is a hash of both, so the same detection has the same id in each run.
    """
    boundary = F.when(F.size(mask) >= 3, mask).otherwise(polygon(b).cast(POINTS))
    return F.struct(F.concat(F.lit("line_"), F.lower(F.hex(F.xxhash64(b, mask)))).alias("id"), midline(b).alias("baseline"), boundary.alias("boundary"))


def degenerate(points: Column) -> Column:
    """Whether two points in a row are the same."""
    i = F.sequence(F.lit(0), F.greatest(F.size(points) - 2, F.lit(0)))
    return F.exists(i, lambda k: (k + 1 < F.size(points)) & (F.get(points, k) == F.get(points, k + 1)))


def tag_id(label: Column) -> Column:
    """A stable number for a label: 24 bits of its SHA-1, modulo 100,000."""
    return F.conv(F.substring(F.sha1(label), 1, 6), 16, 10).cast("long") % 100_000


def short_tag(label: Column) -> Column:
    return F.concat(F.lit("BT"), F.substring(F.sha1(label), 1, 6))


# Line types and their class numbers.
LINE_TYPES = {"CustomLine": 0, "DefaultLine": 1, "DropCapitalLine": 2, "HeadingLine": 3, "InterlinearLine": 4, "MusicLine": 5}


def line_type(tags: Column) -> Column:
    """The first known type that stands in a tag, whatever its case; else DefaultLine."""
    of = lambda tag: F.coalesce(*[F.when(F.lower(tag).contains(t.lower()), F.lit(t)) for t in LINE_TYPES])
    return F.coalesce(F.get(F.array_compact(F.transform(tags, of)), 0), F.lit("DefaultLine"))


def detection_row(class_id: Column, b: Column, width: Column, height: Column) -> Column:
    r"""class cx cy w h on the unit square, six decimals."""
    unit = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    values = [
        unit((b["x1"] + b["x2"]) / 2 / width), unit((b["y1"] + b["y2"]) / 2 / height),
        unit((b["x2"] - b["x1"]) / width), unit((b["y2"] - b["y1"]) / height),
    ]
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id.cast("int"), *values)


def polygon_row(class_id: Column, points: Column, width: Column, height: Column) -> Column:
    r"""class x1 y1 x2 y2 ... on the unit square, six decimals."""
    # a decimal has the digits that format_string("%.6f") gives, in half the time
    unit = lambda v, size: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / size)).cast("decimal(7,6)").cast("string")
    parts = F.transform(points, lambda p: F.concat_ws(" ", unit(p["x"], width), unit(p["y"], height)))
    return F.concat_ws(" ", class_id.cast("int").cast("string"), F.array_join(parts, " "))
