"""Memory of the driver and of Python workers: joins of written pages, batches taken in pieces."""

from unittest.mock import MagicMock

import pyarrow as pa
import pytest
from foliomill.llm import licenses
from foliomill.operators import errors
from foliomill.plans import tasks
from foliomill.sinks import paths
from foliomill.sources import alto
from pyspark.sql import functions as F


def joins(rows):
    """The joins in a plan: lines that name one."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Join" in x]


def test_written_pages_are_not_broadcast(spark):
    """Files of pages that are alike are small, whatever the pages' number: their sizes say nothing about joins (F11)."""
    names = spark.range(3).select(F.lit("d").alias("document"), F.concat(F.lit("p"), "id").alias("page"))
    images = names.withColumn("image", F.concat(F.lit("/i/"), "page", F.lit(".jpg")))
    boxes = {"width": 400, "height": 300, "boxes": [["MainZone", 10, 160, 390, 290], ["MainZone", 12, 160, 390, 290]]}
    layout = tasks.predict_layout(images, "StubLayout", boxes)
    pages = paths.written(alto.parsed_pages(layout), "pages")
    lined = tasks.predict_lines(pages, images, "StubLine", {"lines": 2})
    pages = paths.written(alto.parsed_pages(lined), "pages")
    texts = tasks.predict_pages(pages, names.limit(1), "StubHTR")
    assert joins(layout) and joins(lined) and not [x for x in joins(layout) + joins(lined) if "Broadcast" in x]
    broadcast = [x for x in joins(texts) if "Broadcast" in x]
    assert len(broadcast) < len(joins(texts)) and all("LeftAnti" in x for x in broadcast)  # the few pages that are done
    assert {(r.page, r.text) for r in alto.lines(alto.parsed_pages(texts)).collect()} == {(f"p{i}", f"line line_{k}") for i in (1, 2) for k in (0, 1)}
    done = paths.written(names, "done")
    for most, kind in ((3, "Broadcast"), (2, "SortMerge")):
        (only,) = joins(images.join(paths.joined_small(done, most), ["document", "page"], "left_anti"))
        assert kind in only


class Given(Exception):
    """What was given to mapInArrow()."""


def python_step(monkeypatch, module, call):
    """The function that a module gives to mapInArrow(), without Spark."""

    def given(run, *_):
        raise Given(run)

    rows = MagicMock()
    rows.filter.return_value.select.return_value.mapInArrow.side_effect = given
    with monkeypatch.context() as m:
        m.setattr(module, "F", MagicMock())
        m.setattr(module, "T", MagicMock(), raising=False)
        with pytest.raises(Given) as step:
            call(rows)
    return step.value.args[0]


def test_words_of_many_texts_are_not_held_at_once(monkeypatch):
    """a task's texts are cut into words a megabyte at a time, whatever the Arrow batch."""
    run = python_step(monkeypatch, licenses, lambda docs: licenses.candidate_spans(docs, licenses.TEMPLATES))
    n = 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(["some words here " * 625] * n)], ["a", "b", "text"])
    made = list(run(iter([batch])))
    grams = len({b.num_rows and len(b.column(2)[0]) for b in made})
    assert sum(b.num_rows for b in made) == n * grams
    assert max(b.num_rows for b in made) * 10_000 <= 1 << 20


def test_operations_of_many_pairs_are_not_held_at_once(monkeypatch):
    """operations are counted over some pairs at a time, whatever the Arrow batch; the counts add up."""
    run = python_step(monkeypatch, errors, lambda pairs: errors.operations(pairs))
    n = 2000
    a, b = [[f"x{i}", *["same"] * 100] for i in range(n)], [[f"y{i}", *["same"] * 100] for i in range(n)]
    made = list(run(iter([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(n, pa.string())], ["a", "b", "by"])])))
    assert len(made) > 1 and max(x.num_rows for x in made) < n
    got = [tuple(r.values()) for x in made for r in x.to_pylist()]
    assert sorted(got, key=str) == sorted([(None, "substitution", f"x{i}", f"y{i}", 1) for i in range(n)], key=str)
    empty = pa.RecordBatch.from_arrays([pa.array([["w"]]), pa.array([["w"]]), pa.array(["k"])], ["a", "b", "by"])
    assert [x.num_rows for x in run(iter([empty]))] == [0]  # no operations


def test_many_license_candidates_are_not_broadcast(spark, monkeypatch):
    """files of candidates are small, and each is dealt to 16 salts: texts that can have some meet them by a shuffled join, others
    stay. A bitmap so small that most texts are taken for such changes no row."""
    notes = ["Released under the MIT License", "Licensed under the ISC License", "nothing at all", "", None]
    rows = spark.createDataFrame([(i, None if n is None else f"a{i} {n} b{i}") for i in range(40) for n in notes], "doc_id long, text string")
    few = sorted(licenses.scan(rows).collect(), key=str)
    for bits in (1 << 23, 64):
        monkeypatch.setattr(licenses, "MARKS", bits, raising=False)
        many = licenses.scan(rows, most_small=0)
        assert not [x for x in joins(many) if "Broadcast" in x and "_text_a" in x]
        assert sorted(many.collect(), key=str) == few
    assert sum(r.labels == ["mit"] for r in few) == 40 and len(few) == 200
    one = licenses.scan(rows, most_small=79)  # 80 texts have a candidate, and each of them more spans than one
    assert not [x for x in joins(one) if "Broadcast" in x and "_text_a" in x]
