"""Whole jobs on small folders."""

from __future__ import annotations

import json

from foliant import jobs


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_from_html_to_the_split_index(spark, tmp_path):
    html, text, images = tmp_path / "html", tmp_path / "text.json", tmp_path / "images"
    html.mkdir()
    first, second = "the first line of a paper stands here", "and the second one follows on a new page"
    for k in range(10):
        (html / f"p{k}.html").write_text(f"<article><p>{first} {k}</p><p>{second} {k}</p></article>")
        (images / f"p{k}").mkdir(parents=True)
        for page in range(2 if k else 1):
            (images / f"p{k}" / f"{page}.png").write_bytes(b"png")
    (html / "nopdf.html").write_text("<article><p>x</p></article>")
    lines(text, [{"paper_id": f"p{k}", "page": page, "text": f"{line} {k}"} for k in range(10) for page, line in enumerate((first, second))])
    out = str(tmp_path / "pages")
    for _ in range(2):  # the second run finds nothing to do
        jobs.main(["pages", str(html), str(text), out])
    got = {(r.paper_id, r.page): r.text for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count() == 20
    assert got["p3", 1] == f"[TEXT]{second} 3[END_TEXT]"
    jobs.main(["pages", str(html), str(text), out, "--recompute"])
    assert spark.read.parquet(out).count() == 20

    jobs.main(["index", out, str(images), str(tmp_path / "index")])
    assert spark.read.json(str(tmp_path / "index")).count() == 19
    jobs.main(["split", str(tmp_path / "index"), str(tmp_path / "split"), "--train", "0.5", "--validation", "0.2"])
    papers = {n: {r.paper_id for r in spark.read.schema(jobs.INDEX).json(str(tmp_path / "split" / n)).collect()} for n in ("train", "validation", "test")}
    assert [len(papers[n]) for n in ("train", "validation", "test")] == [5, 2, 3]
    assert len(set.union(*papers.values())) == 10
    jobs.main(["tokens", str(tmp_path / "index"), str(tmp_path / "tokens")])
    assert spark.read.json(str(tmp_path / "tokens")).first().n_pages == 19


def test_markup_and_offsets(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<article><p>x</p></article>")
    jobs.main(["markup", str(tmp_path / "in"), str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).first().name == "a"
    (tmp_path / "x.jsonl").write_text('{"a":"ü"}\n{"b":1}\n')
    jobs.main(["seek", str(tmp_path / "x.jsonl"), str(tmp_path / "seek")])
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "seek")).collect()) == [0, 11]


def test_evaluation_of_two_systems(spark, tmp_path):
    truth = ["one two three four $a$", "five six seven eight", "tail"]
    lines(tmp_path / "base.json", [{"predictions": ["one two three four $b$", "five six seven nine"], "ground_truths": truth}])
    lines(tmp_path / "fine.json", [{"predictions": truth, "ground_truths": truth}])
    jobs.main(["evaluate", str(tmp_path / "base.json"), str(tmp_path / "out"), "--fine", str(tmp_path / "fine.json")])
    got = spark.read.json(str(tmp_path / "out")).first()
    assert (got.n_samples, got.fine_ned, got.fine_formula_f1, got.base_formula_f1) == (2, 1.0, 1.0, 0.0)
    assert got.delta_ned > 0 and got.delta_bleu > 0
    jobs.main(["evaluate", str(tmp_path / "fine.json"), str(tmp_path / "one")])
    assert spark.read.json(str(tmp_path / "one")).first().n_samples == 3
