"""Extracted page text: lines for matching, paragraphs for reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import kernels as K
from foliant.functions import tex as X
from foliant.functions import text as T


def lower_lines(pages: DataFrame) -> DataFrame:
    """paper_id, page, line_no, line: ligatures folded, stripped, lower-cased, blank lines left out."""
    lines = F.transform(F.split(T.fold_ligatures(F.col("text")), "\n"), lambda x: F.lower(T.strip(x)))
    return pages.select("paper_id", "page", F.posexplode(F.filter(lines, lambda x: x != "")).alias("line_no", "line"))


def page_lines(pages: DataFrame) -> DataFrame:
    """paper_id, pages: the lower-cased lines of all pages of a paper, in order; a paper without lines on a page has an empty one."""
    lines = F.filter(F.transform(F.split(T.fold_ligatures(F.col("text")), "\n"), lambda x: F.lower(T.strip(x))), lambda x: x != "")
    rows = pages.select("paper_id", F.struct("page", lines.alias("lines")).alias("p"))
    return rows.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["lines"]).alias("pages"))


def paragraphs(pages: DataFrame) -> DataFrame:
    """paper_id, page, paragraph_no, paragraph: the second ligature table, hyphens at line ends joined, split at blank lines."""
    whole = K.column(X.dehyphenated, "string", T.fold_ligatures(F.col("text"), T.LIGATURES_2))
    return pages.select("paper_id", "page", whole.alias("text")).select("paper_id", "page", F.posexplode(T.paragraphs(F.col("text"))).alias("paragraph_no", "paragraph"))
