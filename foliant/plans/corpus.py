"""Corpus bookkeeping, joins, layout and score statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as T
from foliant.operators import dataset as D
from foliant.operators import layout as Y
from foliant.operators import scores as S

from .tables import BOXES, boxes, table


def seek_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.offsets(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text").select("conv_id", "turn", "offset")


SEEK_MAP = "SELECT conv_id, turn, CAST(coalesce(sum(strlen(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM conversations"


def paper_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "conversations")
    sizes = samples.groupBy("conv_id").agg(F.count("*").alias("n"))
    return D.split_papers(samples, "conv_id").join(sizes, "conv_id").groupBy("split").agg(F.count("*").alias("papers"), F.sum("n").alias("samples"), F.min("conv_id").alias("least"), F.max("conv_id").alias("most"))


PAPER_SPLIT = """
WITH p AS (SELECT conv_id, count(*) AS n, md5('42:' || conv_id) AS h FROM conversations GROUP BY conv_id), o AS (
  SELECT *, row_number() OVER (ORDER BY h, conv_id) AS k, count(*) OVER () AS total FROM p
), s AS (
  SELECT *, CASE WHEN k <= floor(0.8 * total) THEN 'train' WHEN k <= floor(0.8 * total) + floor(0.1 * total) THEN 'validation' ELSE 'test' END AS split FROM o
)
SELECT split, count(*) AS papers, CAST(sum(n) AS BIGINT) AS samples, min(conv_id) AS least, max(conv_id) AS most FROM s GROUP BY split"""


def page_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages; every fifth one failed, every seventh one was empty."""
    pages = table(spark, sf_dir, "conversations").withColumn("repeats", F.when(F.col("turn") % 5 == 4, 1).when(F.col("turn") % 7 == 6, 0))
    return D.assembled(pages.withColumn("text", T.page_marker(F.col("text"), F.col("repeats"), F.col("turn") + 1)), "conv_id", "turn", "text")


PAGE_CONCAT = r"""
WITH p AS (
  SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN E'\n\n[MISSING_PAGE_FAIL:' || (turn + 1) || E']\n\n' WHEN turn % 7 = 6 THEN E'\n\n[MISSING_PAGE_EMPTY:' || (turn + 1) || E']\n\n' ELSE text END AS t FROM conversations
)
SELECT conv_id, count(*) AS n_pages, regexp_replace(trim(coalesce(string_agg(t, '' ORDER BY turn), ''), E' \n\t'), '\n{3,}', E'\n\n', 'g') AS document FROM p GROUP BY conv_id"""


def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = F.concat_ws(",", F.concat_ws("-", "s_nationkey", F.col("s_nationkey") + 3), (F.col("s_nationkey") + 7).cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(D.page_list(spec)).alias("page"))


PAGE_RANGES = "SELECT s_suppkey, CAST(unnest(list_append(range(s_nationkey, s_nationkey + 4), s_nationkey + 7)) - 1 AS INT) AS page FROM supplier"


def citation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cite customers; keys get ordinals within their nation, keys out of the bibliography stay as they are."""
    bib = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    bib = bib.withColumn("ordinal", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    cited = table(spark, sf_dir, "orders").join(bib.select(F.col("c_custkey").alias("o_custkey"), "ordinal"), "o_custkey", "left")
    return cited.select("o_orderkey", F.coalesce(F.concat(F.lit("["), F.col("ordinal").cast("string"), F.lit("]")), F.concat(F.lit("key "), "o_custkey")).alias("citation"))


CITATION_JOIN = """
WITH b AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer WHERE c_acctbal > 0)
SELECT o_orderkey, CASE WHEN k IS NULL THEN 'key ' || o_custkey ELSE '[' || k || ']' END AS citation FROM orders LEFT JOIN b ON o_custkey = c_custkey"""


def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without labels, by source: what is still to be computed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("missing"))


ANTI_MISSING = "SELECT source, count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY source"


def figure_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of orders whose every part is known to be in stock."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_linenumber")
    known = table(spark, sf_dir, "part").where("p_size <= 40").select("p_partkey", "p_size")
    return D.complete_groups(items, known, "l_orderkey", "p_partkey")


FIGURE_COMPLETENESS = """
WITH k AS (SELECT p_partkey, p_size FROM part WHERE p_size <= 40), bad AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM k))
SELECT l_orderkey, p_partkey, l_linenumber, p_size FROM lineitem JOIN k ON l_partkey = p_partkey WHERE l_orderkey NOT IN (SELECT l_orderkey FROM bad)"""


def recognised_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages recognised, in all and in percent, by language and overall."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("hit")).distinct(), "doc_id", "left")
    return docs.rollup("lang").agg(F.count("hit").alias("recognised"), F.count("*").alias("total"), F.round(100 * F.count("hit") / F.greatest(F.count("*"), F.lit(1)), 6).alias("percent"))


RECOGNISED_PAGES = """
SELECT lang, count(h.doc_id) AS recognised, count(*) AS total, round(100 * count(h.doc_id) / greatest(count(*), 1), 6) AS percent
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) h USING (doc_id) GROUP BY ROLLUP (lang)"""


def cell_spec_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest mode of each ship month; of ties the one seen first."""
    li = table(spark, sf_dir, "lineitem").withColumn("month", F.month("l_shipdate"))
    counts = li.groupBy("month", "l_linestatus", "l_returnflag").agg(F.count("*").alias("n"), F.min(F.struct("l_orderkey", "l_linenumber")).alias("first"))
    return D.best_of(counts, ["month"], [F.desc("n"), F.col("first")]).select("month", "l_linestatus", "l_returnflag", "n")


CELL_SPEC_MODE = """
WITH c AS (SELECT month(l_shipdate) AS month, l_linestatus, l_returnflag, count(*) AS n, min((l_orderkey, l_linenumber)) AS f FROM lineitem GROUP BY ALL)
SELECT CAST(month AS INT) AS month, l_linestatus, l_returnflag, n FROM c QUALIFY row_number() OVER (PARTITION BY month ORDER BY n DESC, f) = 1"""


def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.indents(Y.reading_order(boxes(spark, sf_dir))).select("page_id", "box_id", "place", "indent")


READING_ORDER = f"""
WITH {BOXES}, i AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY "column" * 10000000 + floor(y1), box_id) - 1 AS INT) AS place, x1 - min(x1) OVER (PARTITION BY page_id, "column") AS raw FROM boxes
)
SELECT page_id, box_id, place, CASE WHEN label = 'reference' OR raw > 0.35 * width AND label <> 'formula' THEN 0.0 ELSE raw END AS indent FROM i"""


def column_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.column_extents(boxes(spark, sf_dir))


COLUMN_EXTENTS = f"""
WITH {BOXES} SELECT page_id, "column", max(x2) - min(x1) AS extent_x, max(y2) - min(y1) AS extent_y, round(sum((y2 - y1) * (x2 - x1)) / sum(y2 - y1), 6) AS mean_width FROM boxes GROUP BY ALL"""


def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.overlapping(boxes(spark, sf_dir).where("score > 0.5"), 0.1)


BOX_OVERLAPS = f"""
WITH {BOXES}, o AS (
  SELECT x.page_id, x.box_id AS a, y.box_id AS b, (least(x.x2, y.x2) - greatest(x.x1, y.x1)) * (least(x.y2, y.y2) - greatest(x.y1, y.y1)) AS o,
    (x.x2 - x.x1) * (x.y2 - x.y1) AS p, (y.x2 - y.x1) * (y.y2 - y.y1) AS q
  FROM boxes x JOIN boxes y ON x.page_id = y.page_id AND x.box_id < y.box_id AND x.x1 < y.x2 AND y.x1 < x.x2 AND x.y1 < y.y2 AND y.y1 < x.y2 WHERE x.score > 0.5 AND y.score > 0.5
)
SELECT page_id, a, b, round(o / (p + q - o), 6) AS iou, round(o / p, 6) AS in_a, round(o / q, 6) AS in_b FROM o WHERE round(o / (p + q - o), 6) >= 0.1"""


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, pixel and page-relative coordinates of every box."""
    b = (F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    names = ("x1", "y1", "x2", "y2")
    return boxes(spark, sf_dir).select("page_id", "box_id", *[c.alias(f"pad_{n}") for c, n in zip(G.padded(b), names, strict=True)], *[G.points_to_pixels(c).alias(f"px_{n}") for c, n in zip(b, names, strict=True)], *[c.alias(f"rel_{n}") for c, n in zip(G.normalised(b, F.col("width"), F.lit(1000.0)), names, strict=True)])


COORDINATES = f"""
WITH {BOXES}, p AS (SELECT *, least(x2 - x1, y2 - y1) * 0.005 AS pad FROM boxes)
SELECT page_id, box_id, round_even(x1 - pad, 0) AS pad_x1, round_even(y1 - pad, 0) AS pad_y1, round_even(x2 + pad, 0) AS pad_x2, round_even(y2 + pad, 0) AS pad_y2,
  CAST(round_even(x1 * 96 / 72, 0) AS BIGINT) AS px_x1, CAST(round_even(y1 * 96 / 72, 0) AS BIGINT) AS px_y1, CAST(round_even(x2 * 96 / 72, 0) AS BIGINT) AS px_x2, CAST(round_even(y2 * 96 / 72, 0) AS BIGINT) AS px_y2,
  round(x1 / width, 4) AS rel_x1, round(1 - y2 / 1000.0::DOUBLE, 4) AS rel_y1, round(x2 / width, 4) AS rel_x2, round(1 - y1 / 1000.0::DOUBLE, 4) AS rel_y2 FROM p"""


def grid_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells from line items: one row per line, spans from the quantity, every fourth cell blank."""
    cells = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"),
        (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("cell"),
        F.col("l_linenumber").alias("start_row"),
        (F.col("l_linenumber") + F.col("l_quantity").cast("int") % 2).alias("end_row"),
        (F.col("l_linenumber") * 2 % 4).alias("start_col"),
        (F.col("l_linenumber") * 2 % 4 + F.col("l_quantity").cast("int") % 3).alias("end_col"),
        F.when(F.col("l_partkey") % 4 == 0, " ").otherwise("x").alias("content"),
    )
    grid = Y.grid_cells(cells).groupBy("doc", "row", "col").agg(F.min("cell").alias("cell"), F.min_by("content", "cell").alias("content"))
    return Y.neighbours(grid)


GRID_NEIGHBOURS = """
WITH c AS (
  SELECT l_orderkey AS doc, l_linenumber * 1000000 + l_partkey AS cell, l_linenumber AS r, l_linenumber + CAST(l_quantity AS INT) % 2 AS r2, l_linenumber * 2 % 4 AS k, l_linenumber * 2 % 4 + CAST(l_quantity AS INT) % 3 AS k2,
    CASE WHEN l_partkey % 4 = 0 THEN ' ' ELSE 'x' END AS content FROM lineitem
), e AS (SELECT doc, cell, content, unnest(range(r, r2 + 1)) AS row, k, k2 FROM c), f AS (SELECT doc, cell, content, row, unnest(range(k, k2 + 1)) AS col FROM e), g AS (
  SELECT doc, row, col, min(cell) AS cell, arg_min(content, cell) AS content FROM f GROUP BY ALL
), n AS (SELECT * FROM g WHERE trim(content) <> ''), a AS (
  SELECT doc, cell AS source, lead(cell) OVER (PARTITION BY doc, row ORDER BY col) AS target, 'horizontal' AS direction FROM n
  UNION ALL SELECT doc, cell, lead(cell) OVER (PARTITION BY doc, col ORDER BY row), 'vertical' FROM n
)
SELECT DISTINCT * FROM a WHERE target IS NOT NULL AND source <> target"""


def running_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "score")).withColumn("score", F.col("score").cast("double"))
    spread = S.suffix_variance(S.window_variance(scores, "vec_id", "pos", "score"), "vec_id", "pos", "spread", "variation")
    return spread.select("vec_id", "pos", F.round("spread", 6).alias("spread"), F.round("variation", 6).alias("variation"))


RUNNING_VARIANCE = """
WITH e AS (SELECT vec_id, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS s FROM embeddings), w AS (
  SELECT vec_id, pos, var_pop(s) OVER (PARTITION BY vec_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 14 FOLLOWING) / 15 AS spread, count(*) OVER (PARTITION BY vec_id) AS n FROM e
), k AS (SELECT * FROM w WHERE pos < n - 15)
SELECT vec_id, pos, round(spread, 6) AS spread, round(var_pop(spread) OVER (PARTITION BY vec_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS variation FROM k"""


def gini_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return S.impurity(rows.withColumn("bin", F.floor(F.col("n_chars") / 500)), ["bin"], "quality")


GINI_BY_THRESHOLD = """
WITH c AS (SELECT CAST(floor(n_chars / 500) AS BIGINT) AS bin, quality, count(*) AS c FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
SELECT bin, CAST(sum(c) AS BIGINT) AS n, round(sum(c) - sum(c * c) / sum(c), 6) AS gini FROM c GROUP BY bin"""


def class_median_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.median_limits(table(spark, sf_dir, "embeddings"), "label", F.element_at("embedding", 1).cast("double"))


CLASS_MEDIAN_MAD = """
WITH v AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS v FROM embeddings), m AS (SELECT label, quantile_cont(v, 0.5) AS m FROM v GROUP BY label), d AS (
  SELECT label, m, quantile_cont(abs(v - m), 0.5) AS mad FROM v JOIN m USING (label) GROUP BY label, m
)
SELECT label, round(m, 6) AS median, round(m - 5 * mad, 6) AS low, round(m + 5 * mad, 6) AS high FROM d"""

_NAMES = "seek_map paper_split page_concat page_ranges citation_join anti_missing figure_completeness recognised_pages cell_spec_mode reading_order column_extents box_overlaps coordinates grid_neighbours running_variance gini_by_threshold class_median_mad".split()
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
