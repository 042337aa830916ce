"""ALTO pages: reading, writing, scoring, streaming, command line."""

import json

import numpy as np
import pytest
from foliomill import cli
from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.operators import boxes, detection
from foliomill.plans import config, reports, tasks
from foliomill.sinks import alto as out
from foliomill.sinks import exports
from foliomill.sources import alto, files
from foliomill.streaming import pages as stream
from pyspark.sql import functions as F

HEAD = '<{p}alto xmlns{q}="http://www.loc.gov/standards/alto/ns-v4#"><{p}Description><{p}sourceImageInformation><{p}fileName>a.jpg</{p}fileName></{p}sourceImageInformation></{p}Description><{p}Tags><{p}OtherTag ID="BT1" LABEL="MainZone"/><{p}OtherTag ID="BT2" LABEL="NumberingZone"/><{p}OtherTag ID="LT1" LABEL="DefaultLine"/></{p}Tags><{p}Layout><{p}Page WIDTH="640" HEIGHT="480"><{p}PrintSpace>'
TAIL = "</{p}PrintSpace></{p}Page></{p}Layout></{p}alto>"
BLOCK = '<{p}TextBlock ID="block_1" HPOS="10.7" VPOS="10" WIDTH="620" HEIGHT="200" TAGREFS="BT1">{lines}</{p}TextBlock><{p}TextBlock ID="n" TAGREFS="BT2"><{p}TextLine ID="x" BASELINE="1 1 9 1"><{p}String CONTENT="12"/></{p}TextLine></{p}TextBlock>'
LINE = '<{p}TextLine ID="{id}" HPOS="20" VPOS="{y}" WIDTH="600" HEIGHT="40" TAGREFS="LT1" BASELINE="20 {m} 620 {m}"><{p}Shape><{p}Polygon POINTS="20,{y} 620,{y} 620,{e} 20,{e}"/></{p}Shape><{p}String CONTENT="{t}"/></{p}TextLine>'


def page(texts, prefix=""):
    p, q = (f"{prefix}:", f":{prefix}") if prefix else ("", "")
    lines = "".join(LINE.format(p=p, id=f"line_{i + 1}", y=30 + 60 * i, m=50 + 60 * i, e=70 + 60 * i, t=t) for i, t in enumerate(texts))
    return (HEAD + BLOCK + TAIL).format(p=p, q=q, lines=lines)


@pytest.fixture
def folders(tmp_path):
    for side, texts in {"truth": ["a b", "c &amp; d"], "found": ["a x", "c &amp; d"]}.items():
        for doc in ("d1", "d2"):
            (tmp_path / side / doc).mkdir(parents=True)
            (tmp_path / side / doc / "p1.xml").write_text(page(texts, "ns0" if doc == "d2" else ""))
    (tmp_path / "truth" / "d1" / "p9.xml").write_text("<alto><broken")
    (tmp_path / "truth" / "d1" / "p1.jpg").write_text("image")
    (tmp_path / "truth" / "d1" / "metadata.json").write_text(json.dumps({"language": "French", "conventions": {"uv_ij": "modern"}}))
    return tmp_path


def test_read(spark, folders):
    pages = alto.read_pages(spark, f"{folders}/truth").filter("width is not null")
    assert pages.count() == 2
    zones = alto.zones(pages).orderBy("document", "idx").collect()
    assert [(z.id, z.label, tuple(z.box)) for z in zones[:2]] == [("block_1", "MainZone", (10, 10, 630, 210)), ("n", "NumberingZone", (0, 0, 0, 0))]
    lines = alto.lines(pages).orderBy("document", "idx").collect()
    assert [(r.document, r.page, r.id, r.text, r.tags, r.region) for r in lines] == [
        (d, "p1", f"line_{i}", t, ["DefaultLine"], "MainZone") for d in ("d1", "d2") for i, t in ((1, "a b"), (2, "c & d"))
    ]
    grid = alto.score_boxes(alto.lines(pages), pages).orderBy("document", "idx").collect()
    assert [tuple(r.box) for r in grid[:2]] == [(3, 6, 96, 14), (3, 18, 96, 27)]
    assert alto.page_texts(alto.lines(pages, ignored=())).first().text == "a b c & d 12"
    assert alto.text_lines(alto.lines(pages)).count() == 4 and alto.with_baseline(alto.lines(pages)).count() == 4
    assert tuple(tasks.scoreable(pages).first()) == (True, True, True)


def test_geometry_falls_back(spark):
    kinds = "boundary array<struct<x: int, y: int>>, baseline array<struct<x: int, y: int>>, box struct<x1: int, y1: int, x2: int, y2: int>"
    rows = spark.createDataFrame([([(0, 0), (1, 0), (1, 1)], [], None), ([], [(1, 2), (3, 4)], None), ([], [], (0, 0, 10, 20)), ([], [], None)], kinds)
    got = alto.with_geometry(rows).collect()
    assert len(got) == 3 and [tuple(p) for p in got[2].baseline] == [(0, 10), (10, 10)]


def test_write_and_read_back(spark, folders, tmp_path):
    pages = alto.read_pages(spark, f"{folders}/truth").filter("width is not null")
    zones, lines = alto.zones(pages), alto.lines(pages)
    new = spark.createDataFrame([("d1", "p1", "line_1", 'new <&> "text"', 0.5), ("d1", "p1", "line_2", "", 0.9)], "document string, page string, id string, text string, confidence double")
    blocks, put = out.inserted(zones, out.recognised(lines, new).drop("zone"))
    xml = out.rendered(pages, blocks, put)
    out.write_pages(xml, f"{tmp_path}/written", files=True)
    back = alto.read_pages(spark, f"{tmp_path}/written")
    got = {(r.document, r.id): r.text for r in alto.lines(back).collect()}
    assert got == {("d1", "line_1"): 'new <&> "text"', ("d1", "line_2"): None, ("d2", "line_1"): None, ("d2", "line_2"): None}
    assert {(z.id, z.label) for z in alto.zones(back).collect()} == {("block_1", "MainZone")}


def test_orphans_become_blocks(spark, folders):
    pages = alto.read_pages(spark, f"{folders}/truth").filter("document = 'd1' and width is not null")
    kinds = "document string, page string, idx long, id string, baseline array<struct<x: int, y: int>>, boundary array<struct<x: int, y: int>>, text string, confidence double"
    box = lambda y: [(20, y), (620, y), (620, y + 40), (20, y + 40)]
    lines = spark.createDataFrame([("d1", "p1", i, f"n{i}", [(20, y), (620, y)], box(y), "t", 1.0) for i, y in enumerate((180, 230))], kinds)
    blocks, put = out.inserted(alto.zones(pages), lines)
    names = {b.idx: b.id for b in blocks.collect()}
    assert {r.id: names[r.zone] for r in put.collect()} == {"n0": "block_1", "n1": "pseudo_block_0"}
    assert out.rendered(pages, blocks, put).first().xml.count("<TextLine") == 2


def test_split_text_minimal_and_detections(spark, folders):
    pages = alto.read_pages(spark, f"{folders}/truth").filter("width is not null")
    texts = spark.createDataFrame([("d1", "p1", "one\n\ntwo"), ("d2", "p1", "1\n2\n3\n4")], "document string, page string, text string")
    got = out.with_split_text(pages, alto.lines(pages), alto.zones(pages), texts).orderBy("document", "idx").collect()
    assert [(r.id, r.text) for r in got[:2]] == [("line_1", "one"), ("line_2", "two")] and [r.text for r in got[2:]] == ["1", "2", "3", "4"]
    # 480 // 4 = 120 for each line, 10 off the sides and the top
    assert [tuple(r.box) for r in got[2:]] == [(10, 10, 630, 120), (10, 130, 630, 240), (10, 250, 630, 360), (10, 370, 630, 480)]
    assert [tuple(map(tuple, r.baseline)) for r in got[2:4]] == [((10, 70), (630, 70)), ((10, 190), (630, 190))]
    images = spark.createDataFrame([("d", "p", "i.jpg", 100, 50, "hello")], "document string, page string, image string, width int, height int, text string")
    blocks, lines = out.minimal(images)
    assert 'CONTENT="hello"' in out.rendered(images, blocks, lines).first().xml
    found = [("d", "p", i, label, b) for i, (label, b) in enumerate([("MainZone", (0, 0, 90, 40)), ("MainZone", (0, 0, 88, 40)), ("NumberingZone", (0, 45, 9, 50))])]
    found = spark.createDataFrame(found, "document string, page string, idx int, label string, box struct<x1: int, y1: int, x2: int, y2: int>")
    assert [(b.idx, b.id) for b in out.from_detections(found).collect()] == [(0, "block_0")]


def test_listing_and_side_files(spark, folders):
    listed = files.listed(spark, f"{folders}/truth")
    assert sorted((r.folder, r.stem, r.ending) for r in listed.collect()) == [("d1", "metadata", ".json"), ("d1", "p1", ".jpg"), ("d1", "p1", ".xml"), ("d1", "p9", ".xml"), ("d2", "p1", ".xml")]
    assert files.structure(listed).first().kind == "hierarchical" and files.structure(listed.limit(0)).first().ok is False
    paired = files.paired(listed.filter("ending = '.xml'"), listed).collect()
    assert sum(r.image is not None for r in paired) == 1
    meta = files.metadata(spark, f"{folders}/truth")
    assert meta.first().metadata["language"] == "French" and files.conventions(meta).first().conventions == {"uv_ij": "modern"}
    names = spark.createDataFrame([("train", "a"), ("valid", "b"), ("dev", "c"), ("x", "d")], "folder string, stem string")
    assert sorted((r.split, r.stem) for r in files.splits(names).collect()) == [("train", "a"), ("val", "b")]
    assert files.is_split(names).first().has_splits
    (folders / "scores.csv").write_text("page,cer,wer\np1,0.5,x\n")
    rows, has_documents = files.scores(spark, f"{folders}/scores.csv")
    assert rows.first().cer == 0.5 and rows.first().wer is None and not has_documents
    (folders / "set.json").write_text(json.dumps({"characters": [{"character": "ab"}, {"character": "b"}]}))
    assert sorted(r.character for r in files.charset(spark, [f"{folders}/set.json"]).collect()) == ["a", "b"]


def test_scores(spark, folders):
    truth, found = (alto.read_pages(spark, f"{folders}/{x}").filter("width is not null") for x in ("truth", "found"))
    keys = lambda report: {r.key: r.value for r in report["metrics"].collect()}
    same = tasks.SCORERS["htr"](truth, truth)
    assert all(r.cer == 0 for r in same["scores_all_pages"].collect()) and keys(same)["competition/matched_lines"] == "3.0"
    meta = spark.createDataFrame([("d1", {"language": "French", "conventions": "x"}), ("d2", {"language": "Old English"})], "document string, metadata map<string, string>")
    got = reports.text_report(truth, found, meta)
    k = keys(got)
    assert float(k["score/cer"]) == pytest.approx(1 / 12) and k["zonemap/score"] == "0.0" and k["total/total_chars"] == "24.0"
    assert (k["worst/top1_file"], k["worst/top3_file"]) == ("d1/p1", None) and float(k["worst/top1_cer"]) == pytest.approx(1 / 12)
    assert float(k["by_language/Old_English/cer"]) == float(k["score/avg_language_cer"]) == float(k["score/avg_romances_wer"]) / 2 == pytest.approx(1 / 12)
    row = got["results"].first().asDict()
    assert row["score/cer"] == k["score/cer"] and not any(c.startswith("zonemap/") for c in row) and list(row) == sorted(row)
    assert [(r.symbol, r["count"]) for r in got["wer_substitutions"].collect()] == [("b -> x", 2)] == [(r.symbol, r["count"]) for r in got["cer_substitutions"].collect()]
    assert got["wer_deletions"].count() == got["cer_insertions"].count() == 0
    zones = got["results_zonemap"].collect()
    assert [r.metric for r in zones if r.metric.startswith("---")] == [t for t, _ in reports.ZONE_REPORT] and len(zones) == 3 + 7 + 6 + 6
    assert {r.metric: r.value for r in zones}["zonemap/n_match"] == "2.0" and zones[1].description == "Error % (lower=better)"
    documents = {r.document: r for r in got["scores_per_document"].collect()}
    assert documents["d1"]["metadata/language"] == "French" and documents["d1"].pages == 1 and documents["d1"]["zonemap/n_match"] == 2
    assert documents["d1"]["detailed/word_substitutions"] == documents["d1"]["detailed/char_substitutions"] == 1 and documents["d2"]["detailed/word_deletions"] == 0
    assert k["detailed/word_substitutions"] == "1.0" and float(k["accuracy/char_accuracy"]) == pytest.approx(11 / 12)
    assert [tuple(r) for r in reports.feature_tables(got["metrics"]).collect()] == [("language", "French", 0.0833, 0.1667), ("language", "Old_English", 0.0833, 0.1667)]
    assert got["scores_by_language"].count() == 4
    shown = {r.key: r.value for r in reports.shown(got["metrics"]).collect()}
    assert shown["score/cer"] == "0.0833" and shown["total/total_chars"] == "24.0"
    assert all(r.ap == 1.0 for r in tasks.score_lines(truth, found)["precision"].collect())
    # one of two blocks has no area: it is never found
    assert all(r.ap == 0.25 for r in tasks.score_layout(truth, found)["precision"].collect())


def test_density_study(spark):
    scores = spark.createDataFrame([("d", f"p{i}", i / 10, 0.5, "x") for i in range(6)] + [("d", "lost", 0.1, 0.1, "x")], "document string, page string, cer double, wer double, text_len string")
    texts = [("d", f"p{i}", "⁊" * i + "a" * (10 - i)) for i in range(5)] + [("e", "p5", "no"), (None, "p5", "⁊" * 5 + "aaaaa"), (None, "p1", "other")]
    rows = reports.with_densities(reports.scored_texts(scores.drop("text_len"), spark.createDataFrame(texts, "document string, page string, text string")))
    got = {r.page: (r.density_medieval, r.text_len) for r in rows.collect()}
    assert got == {f"p{i}": (i / 10, 10) for i in range(6)}
    study = {(r.set, r.metric): r for r in reports.density_study(rows).collect()}
    assert set(study) == {("medieval", "cer"), ("merged", "cer")} and study["medieval", "cer"].slope == pytest.approx(1) and study["merged", "cer"].n == 6


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    pair = lambda t: [tuple(p) for p in one(G.float_points(F.lit(t)))]
    assert pair("1.5,2 3,4.25") == [(1.5, 2.0), (3.0, 4.25)] == pair("1.5 2 3 4.25") == pair("1.5,2 3 4.25 9") and pair("") == pair("7") == []
    assert tuple(one(T.metric_parts(F.lit("score/avg_main_script_cer")))) == ("average", "main_script", None, "cer")
    assert tuple(one(T.metric_parts(F.lit("by_language/Old_English/wer")))) == ("value", "language", "Old_English", "wer")
    assert one(T.metric_parts(F.lit("score/cer"))) is None
    assert one(T.display_name(F.lit("d"), F.lit("p"))) == "d/p" and one(T.display_name(F.lit(""), F.lit("p"))) == "p" == one(T.display_name(F.lit(None).cast("string"), F.lit("p")))
    known = ("qwen2.5-vl", "llava-next", "blip")
    assert [one(T.supported(F.lit(x).cast("string"), known)) for x in ("blip", "qwen2_5_vl", "llava_next_chat", "other", None)] == [True, True, True, False, False]
    box, mask = G.box(*map(F.lit, (0, 0, 10, 4))), F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (5, 0), (5, 4))])
    line, bare = one(G.detected_line(box, mask)), one(G.detected_line(box, F.array().cast(G.POINTS)))
    assert len(line.boundary) == 3 and len(bare.boundary) == 4 and [tuple(p) for p in line.baseline] == [(0, 2), (10, 2)] and line.id != bare.id == one(G.detected_line(box, F.array().cast(G.POINTS))).id
    found = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (1, 2, 7)], "page int, idx int, class_id int")
    named = boxes.named(found, {0: "MarginTextZone", 2: "Line"})
    assert [(r.idx, r.label) for r in named.orderBy("idx").collect()] == [(0, "Line"), (1, "MarginTextZone"), (2, "7")]
    assert [(r.idx, r.label) for r in boxes.zones_only(named, ["page"]).collect()] == [(0, "MarginTextZone")]
    assert one(alto.without_prefixes(F.lit("<a:b x='q:r'></a:b>"))) == "<b x='q:r'></b>"


def test_pages_beside_images_and_sets(spark, folders):
    kinds = "folder string, stem string, path string"
    images = spark.createDataFrame([("d", "a", "i1"), ("d", "b", "i2"), ("e", "c", "i3"), ("e", "none", "i4")], kinds)
    near = spark.createDataFrame([("d", "a", "near/a")], kinds)
    apart = spark.createDataFrame([("d", "a", "apart/d/a"), ("d", "b", "apart/d/b"), (None, "c", "apart/c"), (None, "b", "apart/b")], kinds)
    got = {r.stem: r.xml for r in files.paired_xml(images, near, apart).collect()}
    assert got == {"a": "near/a", "b": "apart/d/b", "c": "apart/c", "none": None}
    assert {r.xml for r in files.paired_xml(images, near).collect()} == {"near/a", None}
    (folders / "one.json").write_text(json.dumps({"characters": [{"character": "a"}]}))
    (folders / "two.json").write_text(json.dumps({"characters": [{"character": "b"}, {"character": "a"}]}))
    sets = files.named_charsets(spark, {"x": f"{folders}/one.json", "y": f"{folders}/two.json"})
    assert sorted(map(tuple, sets.collect())) == [("merged", "a"), ("merged", "b"), ("x", "a"), ("y", "a"), ("y", "b")]
    with pytest.raises(FileNotFoundError, match="z"):
        files.named_charsets(spark, {"z": f"{folders}/absent.json"})
    with pytest.warns(UserWarning, match="absent"):
        assert files.charset(spark, [f"{folders}/absent.json"]).count() == 0
    (folders / "norms.csv").write_text("source,target,set\nſ,s,base\nž,z,extended\n\u0307,,extended\n")
    assert files.norms(spark, f"{folders}/norms.csv") == {"ſ": "s"} and files.norms(spark, f"{folders}/norms.csv", extended=True)["\u0307"] == ""
    with pytest.raises(ValueError, match="train"):
        files.splits(spark.createDataFrame([("val", "b")], "folder string, stem string"))


def test_texts_of_pages(spark, folders):
    pages = alto.read_pages(spark, f"{folders}/truth")
    lines = alto.lines(pages.filter("width is not null"), ignored=())
    names = files.listed(spark, f"{folders}/truth", "*.xml").select(F.col("folder").alias("document"), F.col("stem").alias("page"))
    assert {(r.document, r.page): r.text for r in alto.page_texts_of(names, lines).collect()} == {
        ("d1", "p1"): "a b c & d 12", ("d2", "p1"): "a b c & d 12", ("d1", "p9"): ""}
    assert alto.texts_in_order(lines).first().texts == ["12", "a b", "c & d"]
    images = files.listed(spark, f"{folders}/truth").filter("ending = '.jpg'")
    assert [(r.document, r.page, r.text) for r in tasks.training_pages(lines, images).collect()] == [("d1", "p1", "a b c & d 12")]
    assert {r.modified for r in tasks.cleaned_counts(lines).collect()} == {0}
    assert {r.modified for r in tasks.cleaned_counts(lines.withColumn("text", F.concat("text", F.lit("$")))).collect()} == {3}
    counts = tasks.by_document(lines.select("document", "page"), lambda x: x.groupby("document", as_index=False).count(), "document string, page long")
    assert sorted(map(tuple, counts.collect())) == [("d1", 3), ("d2", 3)]
    square = pages.filter("width is not null").limit(1)
    assert [tuple(z.box) for z in alto.seen_zones(square).orderBy("idx").collect()] == [(10, 10, 630, 210), (0, 0, 0, 0)]


def test_predict(spark, folders):
    pages = alto.read_pages(spark, f"{folders}/truth").filter("width is not null")
    done = spark.createDataFrame([("d2", "p1")], "document string, page string")
    got = tasks.predict_texts(pages, done, "stubhtr", {"text": "vv"}, batch=1)
    assert [(r.document, r.id, r.text) for r in got.collect()] == [("d1", "line_1", "uu")]  # the second repeats the first
    with pytest.raises(tasks.UnknownTask, match="nothing"):
        tasks.recognise(alto.lines(pages), "nothing")
    samples = tasks.training_blocks(alto.lines(pages), size=1)
    assert samples.count() == 4
    chat = pages.limit(1).select(exports.conversation(F.lit("read"), F.lit("a.jpg"), F.lit("x")).alias("m")).first().m
    assert [m.role for m in chat] == ["user", "assistant"] and chat[0].content[0].image_path == "a.jpg"


def test_stream(spark, folders):
    rows = stream.texts(stream.arriving(spark, f"{folders}/truth"))
    stream.write(rows, f"{folders}/out", f"{folders}/check").awaitTermination()
    first = {(r.document, r.page): r.text for r in spark.read.parquet(f"{folders}/out").collect()}
    assert first[("d1", "p1")] == "a b c & d 12" and first[("d1", "p9")] == ""
    (folders / "truth" / "d2" / "p2.xml").write_text(page(["late"]))
    stream.write(rows, f"{folders}/out", f"{folders}/check").awaitTermination()
    assert spark.read.parquet(f"{folders}/out").count() == len(first) + 1
    odd = page(["x"]).replace('CONTENT="x"', "CONTENT='one' WC=\"0.5\" STYLE=\"a>b\"/><String CONTENT=\"two&#10;x\"/><String CONTENT=\"\"").replace("CONTENT=\"12\"", 'CONTENT="three &lt; café"')
    (folders / "truth" / "d2" / "p3.xml").write_text(odd)
    stream.write(rows, f"{folders}/out", f"{folders}/check").awaitTermination()
    batch = alto.page_texts(alto.lines(alto.read_pages(spark, f"{folders}/truth"), ignored=()))
    want = {(r.document, r.page): r.text for r in batch.select("document", "page", T.cleaned(F.col("text")).alias("text")).collect()}
    got = {(r.document, r.page): r.text for r in spark.read.parquet(f"{folders}/out").filter("text <> ''").collect()}
    assert got == want and got["d2", "p3"] == "one two\nx three  café"


def test_command_line(spark, folders):
    assert cli.main(["score", "-t", "all", "-d", f"{folders}/truth", "-p", f"{folders}/found", "-o", f"{folders}/scores", "--metadata"]) == 0
    read = lambda name: spark.read.option("header", "true").csv(f"{folders}/scores/{name}")
    assert read("htr/scores_all_pages.csv").count() == read("htr/scores_per_page.csv").count() == 2
    assert {r.document for r in read("htr/scores_per_page.csv").collect()} == {"d1", "d2"}
    assert read("htr/scores_by_language.csv").count() == 2 and read("htr/results.csv").count() == 1
    assert read("htr/results_zonemap.csv").first().metric.startswith("---") and read("htr/wer_substitutions.csv").count() == 1
    assert cli.main(["print", "-p", f"{folders}/found", "-o", f"{folders}/json", "--json"]) == 0
    objects = [json.loads(r.value) for r in spark.read.text(f"{folders}/json").collect()]
    assert objects == [{"line_1": "a x", "line_2": "c & d", "x": "12"}] * 2
    with pytest.raises(SystemExit):
        cli.main(["predict"])
    assert cli.main(["study", "-s", f"{folders}/scores/htr/scores_all_pages.csv", "-p", f"{folders}/truth", "-o", f"{folders}/study"]) == 0
    assert spark.read.option("header", "true").csv(f"{folders}/study/scores_with_density.csv").first().text_len == "12"


def test_predict_writes_pages_and_goes_on(spark, folders):
    (folders / "run.yml").write_text("tasks:\n  htr:\n    type: StubHTR\n    config:\n      text: 'w {id}'\n")
    command = ["predict", "-c", f"{folders}/run.yml", "-d", f"{folders}/truth", "-o", f"{folders}/pred"]
    assert cli.main(command) == 0
    made = sorted(str(p.relative_to(folders / "pred")) for p in (folders / "pred").rglob("*") if p.is_file() and p.suffix != ".crc")
    assert made == ["d1/p1.xml", "d2/p1.xml"]
    lines = alto.lines(alto.read_pages(spark, f"{folders}/pred")).orderBy("document", "idx").collect()
    assert [(r.document, r.id, r.text, r.region, len(r.boundary)) for r in lines] == [(d, f"line_{i}", f"w line_{i}", "MainZone", 4) for d in ("d1", "d2") for i in (1, 2)]
    kept = (folders / "pred" / "d1" / "p1.xml").stat().st_mtime_ns
    (folders / "pred" / "d2" / "p1.xml").unlink()
    assert cli.main(command) == 0
    assert (folders / "pred" / "d1" / "p1.xml").stat().st_mtime_ns == kept and (folders / "pred" / "d2" / "p1.xml").exists()


CHAIN = """
reading_order: dbscan
tasks:
  layout: {type: StubLayout, config: {width: 400, height: 300, boxes: [[MainZone, 10, 160, 390, 290], [MainZone, 10, 10, 390, 150], [MainZone, 12, 12, 390, 150], [NumberingZone, 0, 0, 9, 9]]}}
  line: {type: StubLine, config: {lines: 2}}
  htr: {type: StubHTR, config: {text: "w {id}"}}
"""


def test_chained_prediction(spark, folders):
    """Three stubs over a folder of images: blocks, lines and texts as a plain run gives them; a run that was cut off goes on."""
    (folders / "run.yml").write_text(CHAIN)
    for d in ("d1", "d2"):
        (folders / "img" / d).mkdir(parents=True)
        for p in ("p1", "p2"):
            (folders / "img" / d / f"{p}.jpg").write_text("image")
    (folders / "img" / "d1" / "p1.png").write_text("a second image")
    command = ["predict", "-c", f"{folders}/run.yml", "-d", f"{folders}/img", "-o", f"{folders}/chain"]
    assert cli.main(command) == 0
    names = [f"{d}/{p}.xml" for d in ("d1", "d2") for p in ("p1", "p2")]
    made = lambda: sorted(str(p.relative_to(folders / "chain")) for p in (folders / "chain").rglob("*.xml"))
    assert made() == sorted(f"{t}/{n}" for t in ("layout", "line", "htr") for n in names)
    # plain: the smaller of two boxes that cover each other goes, ignored labels go, blocks go from the top; two even lines in each
    blocks = [(10, 10, 390, 150), (10, 160, 390, 290)]
    plain = []
    for d in ("d1", "d2"):
        for p in ("p1", "p2"):
            for k, (x1, y1, x2, y2) in enumerate(blocks):
                step = (y2 - y1) // 2
                plain += [(d, p, f"block_{k}", "MainZone", (x1, y1 + i * step, x2, y1 + (i + 1) * step), f"w line_{2 * k + i}") for i in (0, 1)]
    pages = alto.read_pages(spark, f"{folders}/chain/htr")
    got = [(r.document, r.page, r.zone_id, r.region, tuple(r.box), r.text) for r in alto.lines(pages).collect()]
    assert sorted(got) == sorted(plain)
    assert {(r.image, r.width, r.height) for r in pages.collect()} == {("p1.jpg", 400, 300), ("p2.jpg", 400, 300)}
    stamp = {n: (folders / "chain" / n).stat().st_mtime_ns for n in made()}
    for n in ("line/d2/p1.xml", "htr/d2/p1.xml", "htr/d1/p2.xml"):
        (folders / "chain" / n).unlink()
    (folders / "chain" / "htr" / "d1" / "p2.xml.17.part").write_text("<alto>cut off")
    assert cli.main(command) == 0
    again = {n: (folders / "chain" / n).stat().st_mtime_ns for n in made()}
    assert set(again) == set(stamp) and {n for n in stamp if again[n] != stamp[n]} == {"line/d2/p1.xml", "htr/d2/p1.xml", "htr/d1/p2.xml"}
    # one task alone, from a folder without sub-folders
    assert cli.main(["predict", "-t", "layout", "-c", f"{folders}/run.yml", "-d", f"{folders}/img/d2", "-o", f"{folders}/flat"]) == 0
    assert sorted(p.name for p in (folders / "flat").glob("*.xml")) == ["p1.xml", "p2.xml"]
    assert cli.main(["predict", "-t", "line", "-c", f"{folders}/run.yml", "-d", f"{folders}/flat", "-o", f"{folders}/none"]) == 0  # no images there
    assert cli.main([*command[:-1], f"{folders}/last", "--save-images", "--cleanup-intermediate"]) == 0
    kept = sorted(str(p.relative_to(folders / "last")) for p in (folders / "last").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert kept == sorted([f"htr/{n}" for n in names] + [f"htr/{n[:-4]}.jpg" for n in names])
    assert (folders / "last" / "htr" / "d1" / "p1.jpg").read_text() == "image"
    (folders / "bad.yml").write_text("tasks: {layout: {type: nothing}}")
    with pytest.raises(SystemExit, match="nothing"):
        cli.main(["predict", "-c", f"{folders}/bad.yml", "-d", f"{folders}/img", "-o", f"{folders}/x"])
    with pytest.raises(SystemExit, match="no task"):
        cli.main(["predict", "-t", "line", "-c", f"{folders}/bad.yml", "-d", f"{folders}/img", "-o", f"{folders}/x"])


def test_boxes_of_null_confidence_count_as_zero(spark):
    kinds = "page string, idx long, box struct<x1: int, y1: int, x2: int, y2: int>, confidence double"
    truth = spark.createDataFrame([("p", 0, (0, 0, 10, 10), 1.0)], kinds)
    found = spark.createDataFrame([("p", 0, (0, 0, 10, 10), None), ("p", 1, (0, 0, 10, 10), 0.5)], kinds)
    rows = {r.idx: (r.confidence, r.hit) for r in detection.hits(truth, found, ["page"], [0.5]).collect()}
    assert rows == {0: (0.0, False), 1: (0.5, True)}


def test_dataset_scores_by_document(spark):
    """Means over the curve against a plain loop, in documents with shared and null confidences."""
    draw = np.random.default_rng(4)
    rows = [(d, f"p{draw.integers(4)}", i, float(draw.choice([0.2, 0.9, 0.9001, draw.random()])), t, bool(draw.random() < 0.6)) for d in ("a", "b") for i in range(60) for t in (0.5, 0.75)]
    hit = spark.createDataFrame(rows, "document string, page string, idx long, confidence double, threshold double, hit boolean").repartition(5)
    truth = spark.createDataFrame([(d,) for d in "aab" for _ in range(40)], "document string")
    got = {(r.document, r.threshold): (r.precision, r.recall) for r in detection.curve_means(hit, truth, ["document", "page"], by=["document"]).collect()}
    for (d, t), found in got.items():
        own = sorted((-c, p, i, h) for doc, p, i, c, at, h in rows if (doc, at) == (d, t))
        tp, ps, rs = 0, [], []
        for k, (_, _, _, h) in enumerate(own, 1):
            tp += h
            ps.append(tp / k)
            rs.append(tp / (80 if d == "a" else 40))
        assert found == pytest.approx((np.mean(ps), np.mean(rs)))
    assert len(got) == 4
    keys = {(r.document, r.key) for r in detection.dataset_scores(hit, truth, ["document", "page"], ["document"]).collect()}
    assert keys == {(d, f"dataset_test/{k}") for d in "ab" for k in ("map50-95", "map50", "map75", "precision", "recall")}


def test_detector_set(spark, folders):
    for split in ("train", "valid"):
        (folders / "set" / split).mkdir(parents=True)
        for name in ("p1", "p2"):
            (folders / "set" / split / f"{split}-{name}.xml").write_text(page(["a", "b"]))
            if (split, name) != ("valid", "p2"):
                (folders / "set" / split / f"{split}-{name}.jpg").write_text(f"image of {name}")
    assert cli.main(["prepare-yolo-lines", "-i", f"{folders}/set", "-o", f"{folders}/yolo"]) == 0
    made = sorted(str(p.relative_to(folders / "yolo")) for p in (folders / "yolo").rglob("*") if p.is_file())
    names = [("train", "train-p1"), ("train", "train-p2"), ("val", "valid-p1")]
    assert made == ["data.yaml", *[f"images/{s}/{n}.jpg" for s, n in names], *[f"labels/{s}/{n}.txt" for s, n in names]]
    assert (folders / "yolo" / "labels" / "val" / "valid-p1.txt").read_text().splitlines()[0] == "1 0.500000 0.104167 0.937500 0.083333"
    assert (folders / "yolo" / "images" / "train" / "train-p2.jpg").read_text() == "image of p2"
    lines = (folders / "yolo" / "data.yaml").read_text().splitlines()
    assert lines[1:4] == ["train: images/train", "val: images/val", "names:"] and lines[5] == "  1: DefaultLine"


def test_line_images(spark, folders):
    rows = [("MS 1/a", "one", 300, 40, b"1"), ("MS 1/a", "two", 200, 50, b"2"), (None, None, 100, 30, None)]
    spark.createDataFrame(rows, "shelfmark string, text string, width int, height int, image binary").write.parquet(f"{folders}/lines")
    assert cli.main(["lines-to-alto", "-i", f"{folders}/lines", "-o", f"{folders}/single"]) == 0
    pages = alto.read_pages(spark, f"{folders}/single")
    lines = {r.page: r for r in alto.lines(pages).collect()}
    assert set(lines) == {"MS_1_a_line_00001", "MS_1_a_line_00002", "unknown_line_00001"}
    two = lines["MS_1_a_line_00002"]
    assert two.text == "two" and tuple(two.box) == (2, 2, 198, 48) and lines["unknown_line_00001"].text is None
    assert {r.image for r in pages.collect()} == {f"{p}.jpg" for p in lines}
    assert {p.name: p.read_bytes() for p in (folders / "single").rglob("*.jpg")} == {"MS_1_a_line_00001.jpg": b"1", "MS_1_a_line_00002.jpg": b"2"}
    same = [("s", "same", w, h, bytes([w])) for w, h in ((1, 2), (3, 4), (2, 2), (1, 2))]
    same = spark.createDataFrame(same, "shelfmark string, text string, width int, height int, image binary")
    names = lambda x: sorted((r.page, r.width) for r in out.named_line_images(x).collect())
    assert names(same.repartition(3)) == names(same.orderBy(F.desc("width")).coalesce(1))


def test_config():
    own = config.Config.of({"data": {"train": "a", "test": ["b", "c"], "valid": None}, "tasks": {"htr": {"type": "StubHTR"}, "layout": {}}})
    assert own.data == {"train": ["a"], "test": ["b", "c"]} and list(own.tasks) == ["layout", "htr"] and own.reading_order == "dbscan"
    assert config.Config.of({}).data == {}
    with pytest.raises(ValueError, match="other"):
        config.Config.of({"tasks": {"other": {}}})
