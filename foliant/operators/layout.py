"""Layout boxes: reading order, indents, overlaps, table grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G

#: A column's number weighs more than any height on a page.
COLUMN_WEIGHT = 10_000_000


def reading_order(boxes: DataFrame) -> DataFrame:
    """``place`` of each box (page_id, column, y1, box_id): by column, then height."""
    key = F.col("column") * COLUMN_WEIGHT + F.floor("y1")
    return boxes.withColumn("place", F.row_number().over(Window.partitionBy("page_id").orderBy(key, "box_id")) - 1)


def indents(boxes: DataFrame, share: float = 0.35, exempt: str = "formula", zero: str = "reference") -> DataFrame:
    """``indent``: x less the column's least x; none for references, nor above ``share`` of the page but for formulas."""
    raw = F.col("x1") - F.min("x1").over(Window.partitionBy("page_id", "column"))
    clear = (F.col("label") == zero) | ((raw > share * F.col("width")) & (F.col("label") != exempt))
    return boxes.withColumn("indent", F.when(clear, 0.0).otherwise(raw))


def column_extents(boxes: DataFrame) -> DataFrame:
    """page_id, column, extents and the height-weighted mean width."""
    width, height = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return boxes.groupBy("page_id", "column").agg(
        (F.max("x2") - F.min("x1")).alias("extent_x"), (F.max("y2") - F.min("y1")).alias("extent_y"), F.round(F.sum(height * width) / F.sum(height), 6).alias("mean_width")
    )


#: Height of the bands in which a page's boxes meet; most boxes lie in one or two.
BAND = 256


def overlapping(boxes: DataFrame, least: float) -> DataFrame:
    """page_id, a, b, iou, in_a, in_b: pairs of one page's boxes that overlap by ``least``.

    Boxes meet in horizontal bands of the page and a pair counts in the first
    band that both reach, so a page of many boxes is many tasks and only
    neighbours are compared.
    """
    banded = boxes.withColumn("band", F.explode(F.sequence(F.floor(F.col("y1") / BAND), F.floor(F.col("y2") / BAND))))
    x, y = banded.alias("x"), banded.alias("y")
    a, b = G.box("x"), G.box("y")
    first = F.col("x.band") == F.floor(F.greatest(a[1], b[1]) / BAND)
    pairs = x.join(y, (F.col("x.page_id") == F.col("y.page_id")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.box_id") < F.col("y.box_id")) & first & (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3]))
    both = G.overlap(a, b)
    out = pairs.select(F.col("x.page_id").alias("page_id"), F.col("x.box_id").alias("a"), F.col("y.box_id").alias("b"), F.round(G.iou(a, b), 6).alias("iou"), F.round(both / G.area(a), 6).alias("in_a"), F.round(both / G.area(b), 6).alias("in_b"))
    return out.where(F.col("iou") >= least)


def grid_cells(cells: DataFrame) -> DataFrame:
    """doc, row, col, cell: every grid place that a spanning cell covers."""
    rows = cells.withColumn("row", F.explode(F.sequence("start_row", "end_row")))
    return rows.withColumn("col", F.explode(F.sequence("start_col", "end_col"))).select("doc", "row", "col", "cell", "content")


def neighbours(grid: DataFrame) -> DataFrame:
    """doc, source, target, direction: each non-blank cell and its nearest non-blank one to the right and below."""
    filled = grid.where(F.trim("content") != "")
    right = F.lead("cell").over(Window.partitionBy("doc", "row").orderBy("col"))
    below = F.lead("cell").over(Window.partitionBy("doc", "col").orderBy("row"))
    found = filled.select("doc", F.col("cell").alias("source"), right.alias("target"), F.lit("horizontal").alias("direction"))
    found = found.unionByName(filled.select("doc", F.col("cell").alias("source"), below.alias("target"), F.lit("vertical").alias("direction")))
    return found.where("target IS NOT NULL AND source <> target").distinct()
