"""Layout: duplicate boxes, columns, reading groups, table matches and scores, annotation files, staircase."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import html as H
from foliant.functions import kernels as K
from foliant.functions import scores as S
from foliant.functions import staircase as SC
from foliant.operators import boxes as B
from foliant.operators import layout as Y
from foliant.operators import scores as I
from foliant.sources import records as R

from .tables import BOXES, boxes, dealt, table


def box_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.without_duplicates(boxes(spark, sf_dir))


def column_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = boxes(spark, sf_dir)
    return B.with_columns(found, F.col("label") != "reference")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with a detector label each, by id."""
    names = [x for g in B.GROUPS.values() for x in g] + ["其他"]
    return boxes(spark, sf_dir).withColumn("label", F.element_at(F.array(*map(F.lit, names)), (F.col("box_id") % len(names) + 1).cast("int")))


_NAMES_SQL = "[" + ", ".join(f"'{x}'" for g in B.GROUPS.values() for x in g) + ", '其他']"
_N = sum(len(g) for g in B.GROUPS.values()) + 1
_LABELLED = f"{BOXES}, l AS (SELECT page_id, box_id, \"column\", y1, ({_NAMES_SQL})[CAST(box_id % {_N} AS INT) + 1] AS label FROM boxes)"
_LIST = lambda names: "(" + ", ".join(f"'{x}'" for x in names) + ")"


def reading_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.grouped_reading_order(_labelled(spark, sf_dir))


READING_GROUPS = f"""
WITH {_LABELLED}, g AS (
  SELECT *, CASE {" ".join(f"WHEN label IN {_LIST(names)} THEN '{g}'" for g, names in B.GROUPS.items())} ELSE 'others' END AS "group" FROM l
  UNION ALL SELECT *, 'subtitle' FROM l WHERE label = '子标题' UNION ALL SELECT *, 'footnote' FROM l WHERE label = '注释'
)
SELECT page_id, box_id, "group", CAST(row_number() OVER (PARTITION BY page_id, "group" ORDER BY "column" * 10000000 + floor(y1), box_id) - 1 AS INT) AS place FROM g"""


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.page_parts(_labelled(spark, sf_dir))


PAGE_PARTS = f"""
WITH {_LABELLED}, p AS (SELECT *, CASE WHEN label IN {_LIST(B.HEAD)} THEN 'head' WHEN label IN {_LIST(B.BODY)} THEN 'body' WHEN label IN {_LIST(B.FOOT)} THEN 'foot' ELSE 'others' END AS part FROM l)
SELECT page_id, box_id, part, CAST(row_number() OVER (PARTITION BY page_id, part ORDER BY "column" * 10000000 + floor(y1), box_id) - 1 AS INT) AS place FROM p"""


def crop_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into how many pieces each box is cut, by its height on its page."""
    tallest = F.max(F.col("y2") - F.col("y1")).over(Window.partitionBy("page_id"))
    scaled = (F.col("y2") - F.col("y1")) * (F.col("box_id") % 20 + 1) / 20
    return boxes(spark, sf_dir).select("page_id", "box_id", B.piece_count(scaled, tallest, F.col("label")).cast("int").alias("pieces"))


_LIMITS = " ".join(f"WHEN s > {least} * t THEN {n}" for least, n in B.PIECES)
CROP_PIECES = f"""
WITH {BOXES}, s AS (SELECT page_id, box_id, label, (y2 - y1) * (box_id % 20 + 1) / 20 AS s, max(y2 - y1) OVER (PARTITION BY page_id) AS t FROM boxes)
SELECT page_id, box_id, CAST(CASE WHEN label = 'formula' THEN 1 {_LIMITS} ELSE 1 END AS INT) AS pieces FROM s"""


# -- tables -------------------------------------------------------------------------------
def _found(truth: DataFrame) -> DataFrame:
    """Detections of the true boxes: moved by up to nine pixels, a tenth missing, all of every thirteenth page missing."""
    d = F.col("box_id") % 10
    return truth.where("box_id % 10 <> 7 AND page_id % 13 <> 0").select("page_id", (F.col("box_id") + 5).alias("box_id"), (F.col("x1") + d).alias("x1"), "y1", (F.col("x2") + d).alias("x2"), (F.col("y2") + d).alias("y2"), "score")


_FOUND = """found AS (
  SELECT page_id, box_id + 5 AS box_id, x1 + box_id % 10 AS x1, y1, x2 + box_id % 10 AS x2, y2 + box_id % 10 AS y2, score FROM boxes WHERE box_id % 10 <> 7 AND page_id % 13 <> 0
)"""
_IOU = "(greatest(least(t.x2, f.x2) - greatest(t.x1, f.x1), 0) * greatest(least(t.y2, f.y2) - greatest(t.y1, f.y1), 0))"
_UNION = f"((t.x2 - t.x1) * (t.y2 - t.y1) + (f.x2 - f.x1) * (f.y2 - f.y1) - {_IOU})"


def cell_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = boxes(spark, sf_dir)
    return B.mapped_cells(truth, _found(truth), 0.7)


CELL_MAPPING = f"""
WITH {BOXES}, {_FOUND}
SELECT t.page_id, t.box_id AS truth_id, min(f.box_id) AS found_id FROM boxes t JOIN found f ON t.page_id = f.page_id AND t.x1 < f.x2 AND f.x1 < t.x2 AND t.y1 < f.y2 AND f.y1 < t.y2 AND {_IOU} / {_UNION} >= 0.7 GROUP BY ALL"""


def greedy_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = boxes(spark, sf_dir)
    return B.matched_one_to_one(truth, _found(truth), 0.6)


def table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of the detections at every threshold, pages without any counted as missed, and the weighted score."""
    truth = boxes(spark, sf_dir)
    found = _found(truth)
    real = truth.groupBy("page_id").agg(F.count("*").alias("truth"))
    made = found.groupBy("page_id").agg(F.count("*").alias("predicted"))
    hits = B.cells_by_threshold(truth, found, B.THRESHOLDS).groupBy("page_id").agg(*[F.size(F.collect_set(F.col("firsts")[k])).alias(f"tp{k}") for k in range(len(B.THRESHOLDS))])
    page = real.join(made, "page_id", "left").join(hits, "page_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    each = F.array(*[F.struct(F.lit(least).alias("threshold"), count(F.col(f"tp{k}")).alias("tp")) for k, least in enumerate(B.THRESHOLDS)])
    counts = page.select(F.explode(each).alias("e"), count(F.col("predicted")).alias("predicted"), count(F.col("truth")).alias("truth")).select("e.*", "predicted", "truth")
    return B.table_scores(counts).select("threshold", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


TABLE_SCORES = f"""
WITH {BOXES}, {_FOUND}, k AS (SELECT unnest([0.6, 0.7, 0.8, 0.9])::DOUBLE AS threshold), h AS (
  SELECT threshold, t.page_id, t.box_id, min(f.box_id) AS found_id FROM k, boxes t JOIN found f ON t.page_id = f.page_id AND t.x1 < f.x2 AND f.x1 < t.x2 AND t.y1 < f.y2 AND f.y1 < t.y2 WHERE {_IOU} / {_UNION} >= threshold GROUP BY ALL
), p AS (SELECT threshold, count(*) AS tp FROM (SELECT DISTINCT threshold, page_id, found_id FROM h) GROUP BY threshold), r AS (
  SELECT threshold, tp / (SELECT count(*) FROM found) AS p, tp / (SELECT count(*) FROM boxes) AS r FROM p
), s AS (SELECT threshold, p, r, 2 * p * r / (p + r) AS f FROM r)
SELECT threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM s
UNION ALL SELECT NULL, NULL, NULL, round(sum(threshold * f) / sum(threshold), 6) FROM s"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells from line items: one row per line, two columns a line, every fourth cell blank."""
    li = table(spark, sf_dir, "lineitem")
    grid = li.select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("cell"), F.col("l_linenumber").alias("row"), (F.col("l_partkey") % 2).alias("col"), F.when(F.col("l_partkey") % 4 == 0, " ").otherwise("x").alias("content"))
    return grid.groupBy("doc", "row", "col").agg(F.min("cell").alias("cell"), F.min_by("content", "cell").alias("content"))


def adjacency_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour relations found again: in the found tables every tenth relation is missing and cells carry other ids."""
    truth = Y.neighbours(_cells(spark, sf_dir))
    mapping = truth.select(F.col("doc").alias("page_id"), F.explode(F.array("source", "target")).alias("truth_id")).distinct().where("truth_id % 17 <> 3").withColumn("found_id", F.col("truth_id") + 7)
    found = truth.where("source % 10 <> 1").select("doc", (F.col("source") + 7).alias("source"), (F.col("target") + 7).alias("target"), "direction")
    return B.adjacency_hits(truth, found, mapping)


ADJACENCY_SCORES = """
WITH g AS (
  SELECT l_orderkey AS doc, l_linenumber AS row, l_partkey % 2 AS col, min(l_linenumber * 1000000 + l_partkey) AS cell, arg_min(CASE WHEN l_partkey % 4 = 0 THEN ' ' ELSE 'x' END, l_linenumber * 1000000 + l_partkey) AS content FROM lineitem GROUP BY ALL
), n AS (SELECT * FROM g WHERE trim(content) <> ''), a AS (
  SELECT doc, cell AS source, lead(cell) OVER (PARTITION BY doc, row ORDER BY col) AS target, 'horizontal' AS direction FROM n UNION ALL SELECT doc, cell, lead(cell) OVER (PARTITION BY doc, col ORDER BY row), 'vertical' FROM n
), t AS (SELECT DISTINCT * FROM a WHERE target IS NOT NULL AND source <> target)
SELECT doc AS page_id, count(*) FILTER (source % 17 <> 3 AND target % 17 <> 3 AND source % 10 <> 1) AS tp, count(*) FILTER (source % 10 <> 1) AS predicted, count(*) AS truth FROM t GROUP BY doc"""


def border_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizontal rules of every order as a table row: cells of one or two columns with border weights; and where the cells end."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", (1 + F.col("l_suppkey") % 2).cast("int").alias("w"), (F.col("l_quantity").cast("int") % 3).alias("b")).alias("c"))
    rows = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("c")).alias("c"))
    weights = F.flatten(F.transform("c", lambda c: F.array_repeat(c["b"], c["w"])))
    rules = K.column(lambda w: H.rules_of(w, len(w)), "string", weights)
    ends = F.transform("c", lambda c, i: F.aggregate(F.slice("c", F.lit(1), i + 1), F.lit(0), lambda s, x: s + x["w"]).cast("string"))
    return rows.select("l_orderkey", rules.alias("rules"), F.array_join(ends, ",").alias("ends"))


BORDER_RULES = """
WITH c AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(1 + l_suppkey % 2 AS INT) AS w, CAST(l_quantity AS INT) % 3 AS b, sum(1 + l_suppkey % 2) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, 1 + l_suppkey % 2, CAST(l_quantity AS INT) % 3 ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM lineitem
), p AS (SELECT l_orderkey, unnest(generate_series(e - w + 1, e)) AS k, b, max(e) OVER (PARTITION BY l_orderkey) AS n FROM c), s AS (
  SELECT *, k - row_number() OVER (PARTITION BY l_orderkey, b > 0 ORDER BY k) AS g FROM p
), r AS (SELECT l_orderkey, min(k) AS a, max(k) AS z, arg_min(b, k) AS b, max(n) AS n FROM s WHERE b > 0 GROUP BY l_orderkey, g), x AS (
  SELECT l_orderkey, trim(string_agg(CASE WHEN z - a + 1 = n THEN repeat('\\hline ', b) ELSE '\\cline{' || a || '-' || z || '} ' END, '' ORDER BY a)) AS rules FROM r GROUP BY l_orderkey
), o AS (SELECT l_orderkey, string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) AS ends FROM c GROUP BY l_orderkey)
SELECT l_orderkey, coalesce(rules, '') AS rules, ends FROM o LEFT JOIN x USING (l_orderkey)"""


# -- files ----------------------------------------------------------------------------------------
def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.table_xml(boxes(spark, sf_dir))


TABLE_FILES = f"""
WITH {BOXES}, t AS (
  SELECT page_id, box_id, CAST(floor(x1) AS INT) AS x, CAST(floor(y1) AS INT) AS y, CAST(floor(x2 - x1) AS INT) AS w, CAST(floor(y2 - y1) AS INT) AS h FROM boxes WHERE score >= 0.7
), p AS (SELECT page_id, box_id, x || ',' || y || ' ' || x || ',' || (y + h) || ' ' || (x + w) || ',' || (y + h) || ' ' || (x + w) || ',' || y AS points FROM t),
  k AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY box_id, points) AS k FROM p)
SELECT page_id, '<document filename="cTDaR_t' || lpad(CAST(page_id AS VARCHAR), CAST(greatest(5, length(CAST(page_id AS VARCHAR))) AS INT), '0') || '.jpg">' || string_agg('<table id="' || k || '"><Coords points="' || points || '"/></table>', '' ORDER BY k) || '</document>' AS xml FROM k GROUP BY page_id"""


def annotation_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation files of all pages, written as XML and read back; every fifth file is broken and has no objects."""
    files = R.voc_xml(boxes(spark, sf_dir)).withColumn("xml", F.when(F.col("page_id") % 5 == 0, F.expr("substring(xml, 1, 30)")).otherwise(F.col("xml")))
    return R.voc_objects(files)


ANNOTATION_OBJECTS = f"WITH {BOXES} SELECT page_id, label, floor(x1) AS x1, floor(y1) AS y1, floor(x2) AS x2, floor(y2) AS y2 FROM boxes WHERE page_id % 5 <> 0"


def placed_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every box with its page-relative coordinates as a figure's markup, a caption above or below it."""
    found = boxes(spark, sf_dir)
    b = (F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    caption = (b[0], b[3] + F.when(F.col("box_id") % 2 == 0, 5).otherwise(-400), b[2], b[3] + F.when(F.col("box_id") % 2 == 0, 25).otherwise(-380))
    return found.select("page_id", "box_id", G.figure_markup(F.lit("[FIGURE_TITLE]t[END_FIGURE_TITLE]"), b, caption, F.col("width"), F.lit(1000.0)).alias("markup"))


def _share(x: str) -> str:
    return f"regexp_replace(format('{{:.4f}}', round({x}, 4)), '(\\.[0-9]+?)0+$', '\\1')"


PLACED_CAPTIONS = rf"""
WITH {BOXES}, c AS (
  SELECT *, '[FIGURE_COORDS](x1=' || {_share("x1 / width")} || ', y1=' || {_share("1 - y2 / 1000.0::DOUBLE")} || ', x2=' || {_share("x2 / width")}
    || ', y2=' || {_share("1 - y1 / 1000.0::DOUBLE")} || ')[END_FIGURE_COORDS]' AS f FROM boxes
)
SELECT page_id, box_id, CASE WHEN box_id % 2 = 0 OR y2 - 390 > (y1 + y2) / 2 THEN f || E'\n' || '[FIGURE_TITLE]t[END_FIGURE_TITLE]' ELSE '[FIGURE_TITLE]t[END_FIGURE_TITLE]' || E'\n' || f END || E'\n' AS markup FROM c"""


# -- classifiers ------------------------------------------------------------------------------------
def interval_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary impurity of length classes of labelled documents, and of neighbours together; the class is the label."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return I.interval_impurity(rows, "n_chars", "quality", [-0.5, 300.5, 900.5, 2000.5, 1e9])


INTERVAL_GINI = """
WITH r AS (SELECT CASE WHEN n_chars <= 300.5 THEN 0 WHEN n_chars <= 900.5 THEN 1 WHEN n_chars <= 2000.5 THEN 2 ELSE 3 END AS c, quality FROM documents JOIN labels USING (doc_id)), g AS (
  SELECT k.c AS class, coalesce(round(count(r.c) - sum(CASE WHEN quality = k.c THEN 1 ELSE 0 END) ** 2 / nullif(count(r.c), 0), 6), 0.0) AS gini FROM (SELECT unnest([0, 1, 2, 3]) AS c) k LEFT JOIN r ON r.c = k.c GROUP BY k.c
)
SELECT class, gini, gini + lead(gini) OVER (ORDER BY class) AS step FROM g"""


def binary_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id")
    return I.binary_impurity(rows, ["lang"], F.col("toxic") == 1)


BINARY_GINI = "SELECT lang, count(*) AS n, round(count(*) - sum(toxic) ** 2 / count(*), 6) AS gini FROM documents JOIN labels USING (doc_id) GROUP BY lang"


def class_limits_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians per class, classes without values filled from the class before."""
    medians = I.median_limits(table(spark, sf_dir, "embeddings").where("label % 3 <> 1"), "label", F.element_at("embedding", 1).cast("double")).select("label", "median")
    classes = table(spark, sf_dir, "embeddings").select("label").distinct()
    return I.filled_forward(classes.join(medians, "label", "left"), "label", "median")


CLASS_LIMITS_FILLED = """
WITH m AS (SELECT label, round(quantile_cont(CAST(embedding[1] AS DOUBLE), 0.5), 6) AS median FROM embeddings WHERE label % 3 <> 1 GROUP BY label), c AS (SELECT DISTINCT label FROM embeddings)
SELECT label, coalesce(last_value(median IGNORE NULLS) OVER (ORDER BY label ROWS UNBOUNDED PRECEDING), 0.0) AS median FROM c LEFT JOIN m USING (label)"""


def staircase_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page boundaries over the lines of an order's items: every item is a page of its quantity in lines, with some lines of other pages."""
    item = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    held = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("c"))
    fitted = K.column(SC.stairs, "struct<classes:int,bounds:array<double>,share:double>", F.col("c"))
    return held.select("l_orderkey", fitted.alias("s")).where("s IS NOT NULL").select("l_orderkey", "s.*")


# -- generation ----------------------------------------------------------------------------------------
def _scores(text: str, doc_id: int | None) -> np.ndarray:
    """Token scores of a document: code points of the text, flat behind the 350th in every third document."""
    found = np.frombuffer(text.encode("utf-32-le"), dtype="<u4") % 17 / 2 if text else np.zeros(1)
    if doc_id is not None and doc_id % 3 == 0:
        found[351:] = 5.0
    return found


def _scored(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    """doc_id, text of documents that have scores; ids are keys."""
    return dealt(table(spark, sf_dir, "documents").where("n_chars > 400 AND text IS NOT NULL").select("doc_id", text.alias("text")), "doc_id")


_SCORES = """
scores AS (
  SELECT doc_id, CAST(pos AS INT) AS pos, CASE WHEN doc_id % 3 = 0 AND pos > 350 THEN 5.0 ELSE unicode(c) % 17 / 2 END AS score FROM (
    SELECT doc_id, unnest(string_split(substr(text, 1, 900), '')) AS c, unnest(generate_series(0, least(length(text), 900) - 1)) AS pos FROM documents WHERE n_chars > 400)
)"""


#: The same of whole texts.
_WHOLE_SCORES = _SCORES.replace("substr(text, 1, 900)", "text").replace("least(length(text), 900)", "length(text)")


def repetition_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of whole texts, and where a repeating tail begins."""

    def run(doc_id: int | None, text: str) -> tuple:
        scores = _scores(text, doc_id)
        return len(scores), S.repetition_cut(scores)

    rows = _scored(spark, sf_dir, F.col("text"))
    return rows.select("doc_id", K.column(run, "struct<n:bigint,cut:int>", F.col("doc_id"), F.col("text")).alias("r")).select("doc_id", "r.n", "r.cut")


REPETITION_CUTS = f"""
WITH {_WHOLE_SCORES}, n AS (SELECT doc_id, count(*) AS n FROM scores GROUP BY doc_id), w AS (
  SELECT doc_id, pos, n, var_pop(score) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 14 FOLLOWING) / 15 AS v FROM scores JOIN n USING (doc_id)
), k AS (SELECT * FROM w WHERE pos < n - 15), s AS (
  SELECT doc_id, pos, n, var_pop(v) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS vv FROM k
), f AS (SELECT doc_id, min(pos - 1) AS first, max(pos - 1) AS last, count(*) AS hits FROM s WHERE pos >= 1 AND n - 15 - pos >= 10 AND vv < 0.045 GROUP BY doc_id), c AS (
  SELECT doc_id, n, first, CAST(floor(least(greatest(first, 1) * 1.08::DOUBLE + 120, 4095)) AS INT) AS i, hits > 1 AND last - first + 1 = hits AS whole FROM n LEFT JOIN f USING (doc_id)
)
SELECT doc_id, n, CASE WHEN whole AND i / n <= 0.9 THEN CASE WHEN first < 30 THEN 0 ELSE i END END AS cut FROM c"""


def stop_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir, F.substring("text", 1, 900))
    return rows.select("doc_id", K.column(lambda doc_id, text: S.stop_step(_scores(text, doc_id)), "int", F.col("doc_id"), F.col("text")).alias("stop"))


STOP_STEPS = f"""
WITH {_SCORES}, a AS (
  SELECT doc_id, pos, coalesce(var_samp(score) OVER w / count(*) OVER w, 0) AS v, pos + 1 AS step FROM scores WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)
), b AS (SELECT *, step >= 200 AND coalesce(var_samp(v) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 0) < 0.015 AS below FROM a), c AS (
  SELECT *, below AND coalesce(lag(below) OVER (PARTITION BY doc_id ORDER BY pos), false) AND floor(least((step - 1) * 1.15::DOUBLE + 350, 4095)) >= step AS stops FROM b
)
SELECT doc_id, CAST(min(step) FILTER (stops) AS INT) AS stop FROM c GROUP BY doc_id"""

_SQL = "reading_groups page_parts crop_pieces cell_mapping table_scores adjacency_scores border_rules table_files annotation_objects placed_captions interval_gini binary_gini class_limits_filled repetition_cuts stop_steps".split()
QUERIES = {n: globals()[n] for n in [*_SQL, "box_dedup", "column_classes", "greedy_boxes", "staircase_pages"]}
ORACLES = {n: globals()[n.upper()] for n in _SQL}
