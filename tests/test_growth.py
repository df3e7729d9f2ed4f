"""What a query holds, shuffles or repeats as its tables grow; every test failed before the finding it names."""

from __future__ import annotations

import random
import re
from statistics import pvariance, variance

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliant.functions import kernels as K
from foliant.functions import scores as S
from foliant.functions import staircase as SC
from foliant.operators import boxes as B
from foliant.plans import layout, texts
from foliant.sources import records as R
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kernels_hold_a_piece_of_a_batch(spark):
    """a worker turned a whole batch of texts into Python values and back."""
    rows = spark.range(0, 3000, numPartitions=1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    seen = rows.select(K.batches(lambda a: [len(a)] * len(a), "int", F.col("text")).alias("n"))
    assert 1 < seen.agg(F.max("n")).first()[0] <= K.PIECE // 4000 + 1
    assert [len(a) for a, in K.pieces((pa.array(["x" * 100] * 10),), 250)] == [2, 2, 2, 2, 2]


def test_values_are_lists_and_tuples():
    kind = pa.struct([("id", pa.int64()), ("tags", pa.list_(pa.string()))])
    rows = [[{"id": 1, "tags": ["a", None]}, None], None, [], [{"id": None, "tags": None}]]
    assert K.values(pa.array(rows, pa.list_(kind))) == [[(1, ["a", None]), None], None, [], [(None, None)]]
    assert K.values(pa.array(rows, pa.list_(kind)).slice(1, 3)) == [None, [], [(None, None)]]


@pytest.mark.parametrize("name", ["markup_lines", "html_to_markup", "split_pages"])
def test_pages_pass_one_worker(spark, name):
    """every kernel of a chain had a worker of its own, and html went to two of them."""
    assert plan_of(texts.QUERIES[name](spark, SF)).count("ArrowEvalPython [") == 1


def test_tasks_of_texts_are_bounded(spark, tmp_path, monkeypatch):
    """a file of one row group is one task, however many splits its scan has."""
    from foliant.plans import tables

    path = str(tmp_path / "pages.parquet")
    spark.range(0, 4000, numPartitions=1).select(F.col("id").alias("page_id"), F.sha2(F.col("id").cast("string"), 512).alias("html")).write.parquet(path)
    monkeypatch.setattr(tables, "TASK_BYTES", 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = tables.dealt(spark.read.parquet(path), "page_id")
        assert max(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()) < 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def _windows(scores: list[float], size: int, back: bool) -> list[list[float]]:
    return [scores[max(0, k - size + 1) : k + 1] if back else scores[k : k + size] for k in range(len(scores))]


def slow_cut(scores: list[float]) -> int | None:
    """By the definition, window by window."""
    n = len(scores)
    spread = [pvariance(w) / 15 for w in _windows(scores, 15, False)[: max(0, n - 15)]]
    small = [k - 1 for k in range(1, len(spread)) if len(spread) - k >= 10 and pvariance(spread[k:]) < 0.045]
    if len(small) < 2 or small[-1] - small[0] + 1 != len(small):
        return None
    place = int(min(max(small[0], 1) * 1.08 + 120, 4095.0))
    return None if place / n > 0.9 else 0 if small[0] < 30 else place


def slow_stop(scores: list[float]) -> int | None:
    spread = [variance(w) / len(w) if len(w) > 1 else 0.0 for w in _windows(scores, 15, True)]
    below = [k >= 199 and variance(w) < 0.015 for k, w in enumerate(_windows(spread, 200, True)) if len(w) > 1]
    return next((k + 2 for k in range(1, len(below)) if below[k] and below[k - 1] and min((k + 1) * 1.15 + 350, 4095) // 1 >= k + 2), None)


def test_scores_against_windows():
    """every row took its frame to the text's end anew, in windows over a row a token."""
    draw = random.Random(5)
    stops, cuts = set(), set()
    for n in [1, 2, 15, 16, 25, 26, 27, 199, 200, 201, 202, 260, 420, 700]:
        for flat in (0, 3, 40, 250, n // 2, n - 100, n):
            scores = [5.0 if k >= n - max(0, flat) else draw.randrange(17) / 2 if n % 2 else 8.0 * (k // 40 % 2 * k % 2) for k in range(n)]
            cut, stop = S.repetition_cut(np.array(scores)), S.stop_step(np.array(scores))
            assert (cut, stop) == (slow_cut(scores), slow_stop(scores)), (n, flat)
            cuts.add(cut)
            stops.add(stop)
    assert len(cuts) > 3 and len(stops) > 1
    assert S.repetition_cut(np.array([8.0 * (k // 40 % 2 * k % 2) for k in range(300_000)] + [5.0] * 900_000)) == 4095


def test_repetition_cuts_reads_whole_texts(spark, tmp_path):
    """F2: only the first 900 characters were scored."""
    text = ("f" * 40 + "fv" * 20) * 25 + "f" * 3000
    spark.createDataFrame([(1, text, 5000), (3, text, 5000), (4, None, 5000), (5, "short", 5), (7, "", 500)], "doc_id bigint, text string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n, r.cut) for r in layout.repetition_cuts(spark, str(tmp_path)).collect()}
    assert got.keys() == {1, 3, 7} and got[1][0] == got[3][0] == 5000 and got[7] == (1, None)
    assert 1950 < got[1][1] < 2500 and got[3][1] < 1000
    assert assert_same(layout.repetition_cuts(spark, str(tmp_path)).where("doc_id < 7"), layout.REPETITION_CUTS.replace("FROM documents WHERE", "FROM documents WHERE doc_id < 7 AND"), str(tmp_path)) == 2


def test_staircase_shuffles_items_only(spark):
    """every line of every page was a row, and was shuffled."""
    plan = plan_of(layout.staircase_pages(spark, SF))
    assert "Generate" not in plan and "Window" not in plan
    classes, bounds, share = SC.stairs([(1, 9, 3), (2, 9, 40), (4, 1, 25)])
    labels = [x - (p % 11 == 5 and x > 0) for p, x in enumerate([0] * 3 + [1] * 40 + [2] * 25)]
    assert classes == 3 and bounds == SC.fit(list(range(68)), labels, 3, 68)
    assert share == sum(sum(b // 1 < p for b in bounds) == x for p, x in enumerate(labels)) / 68
    assert SC.stairs([(1, 1, None), (2, 1, 2)])[:2] == (2, SC.fit([0, 1], [1, 1], 2, 2))
    assert SC.stairs([(1, 1, None)]) is None and SC.stairs([(1, 1, 4)]) == (1, [], 1.0)


@pytest.mark.parametrize("most", [1 << 18, 30])
def test_boxes_of_many_pages_at_once(monkeypatch, most):
    """F8, F10: every pair of boxes was compared in Python, page by page; pages of more than ``most`` pairs still are."""
    monkeypatch.setattr(B, "PAIRS", most)
    draw = random.Random(8)

    def page() -> list | None:
        n = draw.choice([None, 0, 1, 2, 3, 5, 9])
        corner = [(draw.randrange(20), draw.randrange(20)) for _ in range(n or 0)]
        return None if n is None else [(k, x * 1.0, y * 1.0, x + draw.randrange(0, 30) * 1.0, y + draw.randrange(0, 30) * 1.0, draw.randrange(3) / 2) for k, (x, y) in enumerate(corner)]

    kind = pa.list_(pa.struct([("box_id", pa.int64()), *[(c, pa.float64()) for c in ("x1", "y1", "x2", "y2", "score")]]))
    truth, found = ([page() for _ in range(600)] for _ in range(2))
    names = [f.name for f in kind.value_type]
    a, b = (pa.array([p and [dict(zip(names, x, strict=True)) for x in p] for p in side], kind) for side in (truth, found))
    assert B.deduped_pages(a.slice(3)).to_pylist() == [B.deduped(p) or [] for p in truth[3:]]
    for least in (0.1, 0.6):
        got = [[(m["truth_id"], m["found_id"]) for m in p] for p in B.matched_pages(a, b, least).to_pylist()]
        assert got == [B.greedy_matches(t, f, least) or [] for t, f in zip(truth, found, strict=True)]


def test_table_scores_joins_boxes_once(spark):
    """detections were joined with truth anew for every threshold."""
    plan = layout.table_scores(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") <= 2


def test_annotation_files_are_parsed_once(spark):
    """every file was parsed once for each of five fields, and an object without a name took the next one's."""
    box = lambda k: f"<bndbox>\n <xmin>{k}</xmin><ymin>2</ymin> <xmax> 3</xmax>\n<ymax>4.5</ymax></bndbox>"
    files = {
        1: f"<?xml version='1.0'?>\n<annotation>\n <size>7</size>\n <object>{box(1)}</object>\n <object a='b'>\n<name> a &amp; b</name>{box(2)}<pose/></object></annotation>\n",
        2: f"<annotation><object><name>x</name>{box(3)}</object></annotation>",
        3: f"<annotation><object><name>x</name>{box(3)}</annotation>",
        4: "<annotation></annotation>",
        5: f"<annotation><object><name>x</name>{box(3)}</object>",
    }
    got = R.voc_objects(spark.createDataFrame(list(files.items()), "page_id long, xml string"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, " a & b", 2.0, 2.0, 3.0, 4.5), (1, None, 1.0, 2.0, 3.0, 4.5), (2, "x", 3.0, 2.0, 3.0, 4.5)]
    plan = plan_of(layout.annotation_objects(spark, SF))
    assert "xpath" not in plan


def test_grams_are_counted_in_bounded_tasks(spark, monkeypatch):
    """a task's table of n-grams grew with its split of the file, and spilled."""
    from foliant.plans import lines, tables

    monkeypatch.setattr(tables, "TASK_BYTES", 20_000)
    plan = plan_of(lines.inverted_index(spark, SF))
    tasks = [int(n) for n in re.findall(r"hashpartitioning\(doc_id#\d+L?, (\d+)\)", plan)]
    assert tasks and min(tasks) > 10
