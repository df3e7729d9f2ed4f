"""Readers, writers, external commands and streams on small files."""

from __future__ import annotations

import io
import json
import tarfile
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from foliant.functions import kernels as K
from foliant.operators import boxes as B
from foliant.operators import corpus as C
from foliant.operators import paging as G
from foliant.operators import scores as S
from foliant.sources import files as FS
from foliant.sources import records as R
from foliant.sources import text as ST
from foliant.streaming import pages as SP


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2308.1.zip", "w") as z:
        z.writestr("main.tex", "a")
        z.writestr("../out.tex", "no")
    with tarfile.open(tmp_path / "2308.2.tar.gz", "w:gz") as t:
        for name, data in (("sub/x.tex", b"b"), ("/etc/x", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
        link = tarfile.TarInfo("link")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(link)
    (tmp_path / "broken.tar").write_bytes(b"nothing")
    rows = FS.read_archives(spark, str(tmp_path)).collect()
    good = {(r.path.rsplit("/", 1)[1], r.name, bytes(r.content)) for r in rows if r.error is None}
    assert good == {("2308.1.zip", "main.tex", b"a"), ("2308.2.tar.gz", "sub/x.tex", b"b")}
    assert [r.path.rsplit("/", 1)[1] for r in rows if r.error] == ["broken.tar"]
    stems = spark.createDataFrame([("x/2308.13418.tar.gz",), ("y/2308.1.zip",), ("plain",)], "path string").select(C.stem_of(F.col("path")).alias("s")).collect()
    assert [r.s for r in stems] == ["2308.13418", "2308.1", "plain"]


def test_html_and_pdfs(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.html").write_text("<p>a\u00a0b&nbsp;c</p>  \n\n <p>d</p>")
    (tmp_path / "deep" / "b.pdf").write_bytes(b"%PDF")
    (tmp_path / "c.txt").write_text("no")
    assert [r.html for r in FS.read_html(spark, str(tmp_path)).collect()] == ["<p>a b c</p>\n<p>d</p>"]
    assert [r.path.rsplit("/", 1)[1] for r in FS.list_pdfs(spark, [str(tmp_path)]).collect()] == ["b.pdf"]
    bad = spark.createDataFrame([(bytearray(b"a\xffb"),)], "c binary").select(FS.text_of(F.col("c")).alias("t")).first().t
    assert bad == "a�b"


def test_folders_of_html_become_markup(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<article><p>x</p></article>")
    (tmp_path / "in" / "b.html").write_text("<p>no article</p>")
    FS.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", "[TEXT]\nx\n[END_TEXT]\n")]


def test_external_commands(spark):
    tasks = spark.createDataFrame([("a", ["echo", "hi"]), ("b", ["sleep", "9"]), ("c", ["no-such-program"]), ("d", ["sh", "-c", "exit 3"])], "paper_id string, command array<string>")
    got = {r.paper_id: r for r in FS.run_external(tasks, 1.0).collect()}
    assert (got["a"].returncode, got["a"].output.strip(), got["a"].timed_out) == (0, "hi", False)
    assert got["b"].timed_out and got["b"].returncode is None
    assert got["c"].returncode is None and not got["c"].timed_out
    assert got["d"].returncode == 3


def test_json_lines(spark, tmp_path):
    lines = [{"image": "1.png", "markdown": "a"}, {"image": "2.png", "markdown": "b"}]
    (tmp_path / "x.jsonl").write_text("\n".join([*map(json.dumps, lines), '{"image": "3.png", "mark']))
    images = spark.createDataFrame([("1.png",), ("3.png",)], "path string")
    schema = "image string, markdown string"
    assert {r.markdown for r in R.read_jsonl(spark, str(tmp_path / "x.jsonl"), schema).collect()} == {"a", "b"}
    assert [r.markdown for r in R.read_jsonl(spark, str(tmp_path / "x.jsonl"), schema, images).collect()] == ["a"]
    assert R.split_path("train.jsonl", "train") == "train.jsonl"
    assert R.split_path("data", "test", "%s.jsonl") == "test.jsonl"
    with pytest.raises(ValueError, match="no split"):
        R.split_path("data", "test", "fixed")


def test_writers(spark, tmp_path):
    pages = spark.createDataFrame([("p", 0, "x"), ("q", 0, "y")], "paper_id string, page int, text string")
    R.write_index(pages, spark.createDataFrame([("q",)], "paper_id string"), str(tmp_path / "index"))
    assert [r.paper_id for r in spark.read.json(str(tmp_path / "index")).collect()] == ["p"]
    R.write_with_debug(pages, str(tmp_path / "out"), str(tmp_path / "debug"))
    assert spark.read.json(str(tmp_path / "debug")).count() == spark.read.parquet(str(tmp_path / "out")).count() == 2
    rows = spark.createDataFrame([("s", 1, "b", "d"), ("s", 0, "a", "c")], "system string, idx int, prediction string, truth string")
    R.write_json(R.results_of(rows, ["system"]), str(tmp_path / "results"))
    back = R.result_rows(spark.read.json(str(tmp_path / "results"))).collect()
    assert sorted((r.idx, r.prediction, r.truth) for r in back) == [(0, "a", "c"), (1, "b", "d")]
    (tmp_path / "figs.json").write_text(json.dumps({"paper_id": "p", "figures": [{"name": "1", "figType": "Figure", "page": 0, "caption": "c", "regionBoundary": {"x1": 1.0, "y1": 2.0, "x2": 3.0, "y2": 4.0}}]}))
    assert R.read_figures(spark, str(tmp_path / "figs.json")).first().figures[0].regionBoundary.x2 == 3.0


def test_offsets_lead_to_lines(spark, tmp_path):
    from foliant.operators import dataset as D

    lines = spark.createDataFrame([("f", k, t) for k, t in enumerate(["a", "ü", "", "dd"])], "file string, line_no int, line string")
    seek = D.offsets(lines, ["file"], "line_no", "line").select("file", "line_no", "offset")
    assert [r.offset for r in seek.orderBy("line_no").collect()] == [0, 2, 5, 6]
    wanted = spark.createDataFrame([("f", 5), ("f", 6)], "file string, offset bigint")
    assert sorted(r.line for r in R.at_offsets(lines, seek, wanted).collect()) == ["", "dd"]


def test_offsets_over_blocks(spark, monkeypatch):
    from foliant.operators import dataset as D

    monkeypatch.setattr(D, "BLOCK", 3)
    texts = ["x" * (k % 5) for k in range(20)]
    lines = spark.createDataFrame([("f", k, t) for k, t in enumerate(texts)], "file string, line_no int, line string")
    got = [r.offset for r in D.offsets(lines, ["file"], "line_no", "line").orderBy("line_no").collect()]
    assert got == [sum(len(t) + 1 for t in texts[:k]) for k in range(20)]


def test_page_text(spark):
    pages = spark.createDataFrame([("p", 0, " ﬁRst \n\n\nB"), ("p", 1, None), ("p", 2, "")], "paper_id string, page int, text string")
    assert [(r.page, r.line_no, r.line) for r in ST.lower_lines(pages).orderBy("page", "line_no").collect()] == [(0, 0, "first"), (0, 1, "b")]
    held = ST.page_lines(pages.where("text IS NOT NULL")).first().pages
    assert held == [["first", "b"], []]
    split = K.column(G.split_markup, "array<struct<text:string,valid:boolean>>", F.lit("first line of all\nb"), F.array(F.array(F.lit("first line of all"))))
    assert spark.range(1).select(split.alias("s")).first().s[0].text == "[TEXT]first line of all[END_TEXT]"


def test_annotations(spark):
    files = spark.createDataFrame([("a", "<annotation><object><name>x</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object></annotation>"), ("b", "<annot"), ("c", None)], "file string, xml string")
    assert [tuple(r) for r in R.voc_objects(files).collect()] == [("a", "x", 1.0, 2.0, 3.0, 4.0)]


def test_sums_that_divide_by_nothing(spark):
    counts = spark.createDataFrame([(0.6, 0, 0, 3), (0.9, 1, 2, 2)], "threshold double, tp long, predicted long, truth long")
    got = {r.threshold: r.f1 for r in B.table_scores(counts).collect()}
    assert got == {0.6: 0.0, 0.9: 0.5, None: 0.0}
    empty = spark.createDataFrame([("a", 0, 0, 0)], "k string, tp long, predicted long, truth long")
    assert S.micro_prf(empty, ["k"]).first().f1 is None
    means = C.metric_means(spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("b", None)], "k string, m double"), ["k"], ["m"]).collect()
    assert all(r.m != r.m for r in means)


def test_dots_and_shares(spark):
    from foliant.operators import dataset as D

    assert B.merged_dots([(0, 5, 4, 6), (1, 0, 2, 2), (6, 5, 3, 6)]) == [(0, 0, 4, 11), (6, 5, 3, 6)]
    assert B.merged_dots([]) == [] and B.merged_dots(None) is None
    with pytest.raises(ValueError, match="no parts"):
        D.split_papers(spark.range(3).toDF("id"), "id", 0.9, 0.2)


def test_impurity_reductions(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 0)], "x int, c int")
    each = S.interval_impurity(rows, "x", "c", [0.0, 2.0, 4.0])
    assert [(r["class"], r.gini, r.step) for r in each.orderBy("class").collect()] == [(0, 0.0, 1.5), (1, 1.5, None)]
    assert S.reduced(each, "sum").first().gini == 1.5
    assert S.reduced(each, "mean").first().gini == 0.75
    assert S.reduced(each, "none") is each


def test_streamed_pages_become_documents(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    at = "2024-01-01T00:0{}:00.000Z"
    rows = [(1, 0, 2, "a\n\n\n", at.format(0)), (2, 0, 2, "only", at.format(0)), (1, 1, 2, "\nb ", at.format(1)), (1, 1, 2, "again", at.format(1))]
    (src / "1.json").write_text("\n".join(json.dumps(dict(zip(("doc_id", "page", "n_pages", "text", "at"), r, strict=True))) for r in rows))
    query = SP.documents(SP.read_pages(spark, str(src))).writeStream.format("memory").queryName("docs").option("checkpointLocation", out).outputMode("append").start()
    try:
        deadline = time.time() + 60
        query.processAllAvailable()
        (src / "2.json").write_text(json.dumps({"doc_id": 3, "page": 0, "n_pages": 1, "text": "late", "at": "2024-01-01T03:00:00.000Z"}))
        while time.time() < deadline:
            query.processAllAvailable()
            got = {r.doc_id: (r.complete, r.document) for r in spark.sql("SELECT * FROM docs").collect()}
            if 2 in got:
                break
            time.sleep(0.5)
        assert got[1] == (True, "a\n\nb")
        assert got[3] == (True, "late")
        assert got[2] == (False, "only")
    finally:
        query.stop()


def test_sessions(spark):
    events = spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:00:20"), ("u", "2024-01-01 00:02:00")], "u string, t string").select("u", F.to_timestamp("t").alias("at"))
    assert sorted(r.n for r in SP.sessions(events, "u", "1 minute").collect()) == [1, 2]
