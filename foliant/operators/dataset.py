"""Corpus bookkeeping: discovery, picks, splits, offsets, page assembly, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as T


def best_of(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row of each group, the first in a total order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


#: Lines of one block of a file, whose offsets are found in one task.
BLOCK = 4096


def offsets(rows: DataFrame, by: list[str], order: str, line: str) -> DataFrame:
    """``offset``: UTF-8 bytes in front of each line of its file, newlines counted; ``order`` is a line number.

    Blocks of lines are summed first, and only their sums are cumulated over a
    whole file, so a file of any length is many tasks.
    """
    size = F.coalesce(F.octet_length(line), F.lit(0)) + 1
    blocked = rows.withColumn("__block", F.floor(F.col(order) / BLOCK))
    sums = blocked.groupBy(*by, "__block").agg(F.sum(size).alias("__bytes"))
    front = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("__before", F.coalesce(F.sum("__bytes").over(front), F.lit(0))).drop("__bytes")
    inside = Window.partitionBy(*by, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocked.withColumn("__inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(before, [*by, "__block"])
    return placed.withColumn("offset", (F.col("__before") + F.col("__inside")).cast("long")).drop("__block", "__before", "__inside")


def split_papers(samples: DataFrame, id_col: str, train: float = 0.8, validation: float = 0.1, seed: str = "42") -> DataFrame:
    """id and split of every paper, whole papers at a time; shares that are negative or above 1 together are an error.

    Papers are ordered by a hash of seed and id; the first floor(train * n) are
    train, the next floor(validation * n) validation, the rest test.  The place
    in that order is a count over hash ranges plus a place inside one, so no
    task sees all papers.
    """
    if min(train, validation) < 0 or train + validation > 1:
        raise ValueError(f"shares {train} and {validation} are no parts of a whole")
    papers = samples.select(id_col).distinct().withColumn("h", F.md5(F.concat(F.lit(seed + ":"), F.col(id_col).cast("string"))))
    papers = papers.withColumn("cell", F.substring("h", 1, 3))
    cells = papers.groupBy("cell").agg(F.count("*").alias("n"))  # at most 4096 rows
    before = cells.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("cell", "before")
    total = cells.agg(F.sum("n").alias("total"))
    placed = papers.join(F.broadcast(before), "cell").join(F.broadcast(total))
    place = F.col("before") + F.row_number().over(Window.partitionBy("cell").orderBy("h", id_col))
    n_train, n_validation = F.floor(F.col("total") * train), F.floor(F.col("total") * validation)
    split = F.when(F.col("place") <= n_train, "train").when(F.col("place") <= n_train + n_validation, "validation").otherwise("test")
    return placed.withColumn("place", place).withColumn("split", split).select(id_col, "split")


def assembled(pages: DataFrame, id_col: str, page_col: str, text_col: str) -> DataFrame:
    """id, n_pages, document: page texts in order, stripped, three or more newlines as two."""
    ordered = pages.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(page_col, text_col))).alias("p"), F.count("*").alias("n_pages"))
    whole = F.array_join(F.transform("p", lambda p: p[text_col]), "")
    return ordered.select(id_col, "n_pages", F.regexp_replace(T.strip(whole), "\n{3,}", "\n\n").alias("document"))


def page_list(spec: Column) -> Column:
    """Zero-based pages of ``1-4,7``."""
    one = lambda part: F.sequence(F.split(part, "-")[0].cast("int"), F.element_at(F.split(part, "-"), -1).cast("int"))
    return F.transform(F.flatten(F.transform(F.split(spec, ","), one)), lambda p: p - 1)


def complete_groups(rows: DataFrame, known: DataFrame, by: str, key: str) -> DataFrame:
    """Rows joined with ``known`` on key, but only of groups that have no unmatched row."""
    lacking = rows.join(known.select(key), key, "left_anti").select(by).distinct()
    return rows.join(lacking, by, "left_anti").join(known, key)
