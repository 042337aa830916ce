"""Pages that are parsed once, ALTO as a data source, and files whose texts are cleaned."""

import os

from foliomill import cli
from foliomill.operators import rollup
from foliomill.sinks import alto as out
from foliomill.sinks import paths
from foliomill.sources import alto, alto_source, page_table
from pyspark.sql import functions as F

from test_alto import page


def made(root, names):
    for name, texts in names.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(page(texts))


def texts_of(pages):
    return {(r.document, r.page): r.text for r in alto.page_texts(alto.lines(pages)).collect()}


def test_only_new_and_changed_files_are_opened(spark, tmp_path):
    root = tmp_path / "pages"
    made(root, {"d1/a.xml": ["one"], "d1/b+c d.xml": ["two"], "d2/a.xml": ["three"]})
    (root / "d2" / "broken.xml").write_text("<alto")
    table = page_table.PageTable(spark, str(root), str(tmp_path / "table"))
    assert texts_of(table.refresh()) == {("d1", "a"): "one", ("d1", "b+c d"): "two", ("d2", "a"): "three"} == texts_of(alto.read_pages(spark, str(root)))
    # other texts under the same length and time: only a file that is opened again could show them
    path = root / "d1" / "a.xml"
    stamp = path.stat()
    path.write_text(path.read_text().replace("one", "xyz"))
    os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    made(root, {"d3/new.xml": ["four"]})
    (root / "d2" / "a.xml").write_text(page(["changed"]))
    (root / "d1" / "b+c d.xml").unlink()
    want = {("d1", "a"): "one", ("d2", "a"): "changed", ("d3", "new"): "four"}
    assert texts_of(table.refresh()) == want
    assert spark.read.parquet(str(tmp_path / "table")).count() == 6  # four, then two
    assert texts_of(table.refresh()) == want and spark.read.parquet(str(tmp_path / "table")).count() == 6
    table.compact()
    assert texts_of(table.pages()) == want and spark.read.parquet(str(tmp_path / "table")).count() == 4


def test_scores_from_kept_pages(spark, tmp_path):
    made(tmp_path / "truth", {"d/a.xml": ["one two"]})
    made(tmp_path / "found", {"d/a.xml": ["one too"]})
    command = ["score", "-t", "htr", "-d", f"{tmp_path}/truth", "-p", f"{tmp_path}/found", "--tables", f"{tmp_path}/kept"]
    assert cli.main([*command, "-o", f"{tmp_path}/s1"]) == cli.main([*command, "-o", f"{tmp_path}/s2"]) == 0
    first, second = (spark.read.option("header", "true").csv(f"{tmp_path}/{s}/htr/scores_all_pages.csv").collect() for s in ("s1", "s2"))
    assert first == second and len(first) == 1 and spark.read.parquet(f"{tmp_path}/kept/truth").count() == 1


def test_alto_as_a_data_source(spark, tmp_path):
    made(tmp_path, {"d1/a.xml": ["one"], "d2/b.xml": ["two"], "c.xml": ["root"]})
    rows = alto_source.load(spark, str(tmp_path))
    assert texts_of(alto.parsed_pages(rows)) == {("d1", "a"): "one", ("d2", "b"): "two", ("", "c"): "root"}
    (tmp_path / "d2" / "b.xml").chmod(0o000)
    (tmp_path / "d2").chmod(0o000)  # a reader that looked there would fail, unless it may read all
    one = rows.filter("document = 'd1'")
    assert [(r.document, r.page) for r in one.collect()] == [("d1", "a")]
    (tmp_path / "d2").chmod(0o755)
    reader = alto_source.AltoReader(f"file:{tmp_path}")
    from pyspark.sql.datasource import EqualTo, In, IsNotNull

    left = list(reader.pushFilters([EqualTo(("document",), "d1"), IsNotNull(("document",)), EqualTo(("page",), "a"), In(("document",), ("d1", "d2"))]))
    assert [type(f).__name__ for f in left] == ["IsNotNull", "EqualTo"] and reader.wanted == {"d1"}
    assert [p.document for p in reader.partitions()] == ["d1"] and sum(len(p.names) for p in reader.partitions()) == 1


def test_clean_texts_in_place(spark, tmp_path):
    odd = page(["a&amp;b [x] &#118;&#x76;", "plain"]).replace('CONTENT="plain"', "WC='0.5' CONTENT='&lt;t&gt;it\'s'".replace("\\'", "&apos;"))
    rows = spark.createDataFrame([(odd,), ("<alto>none</alto>",)], "xml string")
    got = {r.xml[:12]: r for r in out.with_clean_texts(rows).collect()}
    assert got["<alto>none</"].xml == "<alto>none</alto>" and got["<alto>none</"].modified == 0
    clean = next(r for k, r in got.items() if k != "<alto>none</")
    assert clean.modified == 2
    pages = alto.parsed_pages(spark.createDataFrame([("d", "p", odd), ("d", "q", clean.xml)], "document string, page string, xml string"))
    lines = {(r.page, r.idx): r.text for r in alto.lines(pages, ignored=()).collect()}
    want = spark.createDataFrame([(k[1], v) for k, v in lines.items() if k[0] == "p"], "idx long, text string")
    from foliomill.functions import text as T

    for r in want.select("idx", T.cleaned(F.col("text")).alias("text")).collect():
        assert (lines["q", r.idx] or "") == r.text
    made(tmp_path / "in", {"d1/a.xml": ["ivvo"], "b.xml": ["12"]})
    before = (tmp_path / "in" / "b.xml").stat().st_mtime_ns
    assert cli.main(["clean", "-i", f"{tmp_path}/in", "-o", f"{tmp_path}/copy"]) == 0
    assert sorted(str(p.relative_to(tmp_path / "copy")) for p in (tmp_path / "copy").rglob("*.xml")) == ["b.xml", "d1/a.xml"]
    assert 'CONTENT="ivvo"' in (tmp_path / "in" / "d1" / "a.xml").read_text() and 'CONTENT="iuuo"' in (tmp_path / "copy" / "d1" / "a.xml").read_text()
    assert cli.main(["clean", "-i", f"{tmp_path}/in"]) == 0
    assert 'CONTENT="iuuo"' in (tmp_path / "in" / "d1" / "a.xml").read_text() and (tmp_path / "in" / "b.xml").stat().st_mtime_ns == before


def test_a_run_leaves_no_tables(spark, tmp_path):
    """Tables of a run are under its folder and go with it, also after an error; runs may stand in one another."""
    rows = spark.range(5)
    with paths.run(spark, "outer") as outer:
        kept = paths.written(rows, "a")
        with paths.run(spark, "inner") as inner:
            assert inner.startswith(outer) and paths.written(rows, "b").count() == 5 and os.listdir(inner)
        assert not os.path.exists(inner) and kept.count() == 5 and kept.inputFiles()[0].startswith("file:" + "//" * ("//" in kept.inputFiles()[0]) + outer)
    assert not os.path.exists(outer)
    try:
        with paths.run(spark) as failed:
            paths.written(rows, "a")
            raise RuntimeError
    except RuntimeError:
        assert not os.path.exists(failed)
    with paths.run(spark, keep=True) as left:
        paths.written(rows, "a")
    assert os.path.exists(left) and paths.removed(spark, left) and not os.path.exists(left)
    assert not paths.shared_folder(spark, "x").startswith(outer)


def test_numbers_within_a_key_that_has_most_rows(spark):
    rows = [(k, i % 7, i) for i in range(400) for k in ([None] if i % 3 else ["a", "b"])]
    frame = spark.createDataFrame(rows, "k string, o int, i int").repartition(6)
    want = {}
    for k in (None, "a", "b"):
        want |= {(k, i): n for n, (_, i) in enumerate(sorted((o, i) for q, o, i in rows if q == k), 1)}
    for parts in (1, 5, 20):
        got = {(r.k, r.i): r.n for r in rollup.numbered(frame, "k", ["o", "i"], "n", parts=parts).collect()}
        assert got == want
