"""Corpus relations: page index, figures, paper inputs, candidate picks, run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as T

# fixed values: file names that hold a paper's main source, best first
MAIN_NAMES = ("main.tex", "paper.tex", "root.tex", "manuscript.tex", "ms.tex")


# -- sources of a paper -----------------------------------------------------------
def stem_of(path: Column) -> Column:
    """File name without folders and without its extension; ``.tar.gz`` is one extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?i)(\.tar\.gz|\.[^.]*)\z", "")


def discovered(archives: DataFrame, pdfs: DataFrame, path: str = "path") -> DataFrame:
    """paper_id: stems of archives and of PDFs, each once, sorted."""
    stems = archives.select(stem_of(F.col(path)).alias("paper_id")).unionByName(pdfs.select(stem_of(F.col(path)).alias("paper_id")))
    return stems.distinct().orderBy("paper_id")


def main_tex(files: DataFrame) -> DataFrame:
    """paper_id, name of each paper's main source among its files (paper_id, name, content).

    A lone file is it; else the first by name that declares a class and begins a
    document; else the best of MAIN_NAMES; else the first by name.
    """
    whole = F.contains("content", F.lit("\\documentclass")) & F.contains("content", F.lit("\\begin{document}"))
    names = F.array(*map(F.lit, MAIN_NAMES))
    named = F.array_position(names, F.element_at(F.split("name", "/"), -1))
    rank = F.when(F.coalesce(whole, F.lit(False)), F.lit(0)).when(named > 0, named.cast("int")).otherwise(len(MAIN_NAMES) + 1)
    return files.groupBy("paper_id").agg(F.min(F.struct(rank.alias("rank"), "name")).alias("best")).select("paper_id", "best.name")


def bibliography_file(files: DataFrame) -> DataFrame:
    """paper_id, name of each paper's bibliography: the one named main, else the first by name."""
    rank = F.when(stem_of(F.col("name")) == "main", 0).otherwise(1)
    return files.groupBy("paper_id").agg(F.min(F.struct(rank.alias("rank"), "name")).alias("best")).select("paper_id", "best.name")


def paper_inputs(pages: DataFrame, pdfs: DataFrame, figures: DataFrame) -> DataFrame:
    """Papers that have HTML and a PDF, with their figure file if there is one; ``to_compute`` says that there is none."""
    held = pages.join(pdfs, "paper_id").join(figures, "paper_id", "left")
    return held.withColumn("to_compute", F.col("figure_path").isNull())


# -- page index ---------------------------------------------------------------------
def page_number(stem: Column) -> Column:
    """The number that a file stem is, 0 for anything else."""
    return F.when(stem.rlike(r"^[0-9]+\z"), stem.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def kept_pages(pages: DataFrame, bad: DataFrame) -> DataFrame:
    """Pages (paper_id, page, text) with text that are not among the bad ones."""
    return pages.where(F.coalesce(T.strip(F.col("text")) != "", F.lit(False))).join(bad.select("paper_id", "page"), ["paper_id", "page"], "left_anti")


def indexed_pages(pages: DataFrame, images: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pages that have an image and lie within the paper's metadata, joined with the metadata of their page."""
    seen = pages.join(images.select("paper_id", "page").distinct(), ["paper_id", "page"], "left_semi")
    return seen.join(metadata, ["paper_id", "page"])


def figures_of_pages(papers: DataFrame, dpi: int = 96) -> DataFrame:
    """paper_id, page, name and pixel box of each figure of (paper_id, n_pages, figures); pages out of range are dropped."""
    one = papers.select("paper_id", "n_pages", F.explode("figures").alias("f")).where((F.col("f.page") >= 0) & (F.col("f.page") < F.col("n_pages")))
    return one.select("paper_id", "f.page", "f.name", *[G.points_to_pixels(F.col(f"f.{c}"), dpi).alias(c) for c in ("x1", "y1", "x2", "y2")])


def figure_names(figures: DataFrame) -> DataFrame:
    """paper_id, page, names: the set of figure names on each page, sorted."""
    return figures.groupBy("paper_id", "page").agg(F.array_sort(F.collect_set("name")).alias("names"))


def figure_number(label: Column) -> Column:
    """Digits at the end of a figure label; null where it ends in none."""
    found = F.regexp_extract(label, r"([0-9]+)\z", 1)
    return F.when(found != "", found)


def valid_figures(mentions: DataFrame, figures: DataFrame) -> DataFrame:
    """Mentions (paper_id, page, name) of figures that stand on that page."""
    return mentions.join(figures.select("paper_id", "page", "name"), ["paper_id", "page", "name"], "left_semi")


def with_objects(lines: DataFrame, objects: DataFrame) -> DataFrame:
    """Lines with the object whose title they are (title, object), all others as they are."""
    return lines.join(objects, lines["line"] == objects["title"], "left").withColumn("line", F.coalesce("object", "line")).drop("title", "object")


# -- candidates ---------------------------------------------------------------------
def band(queries: DataFrame, lines: DataFrame, ahead: int, behind: int = 0) -> DataFrame:
    """Lines of the query's document whose local index lies from ``pointer`` - behind to ``pointer`` + ahead."""
    near = F.col("local_index").between(F.col("pointer") - behind, F.col("pointer") + ahead)
    return queries.join(lines, "doc_id").where(near)


def containing(queries: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of the query's document that hold its squeezed text, or that it holds if they are not short."""
    q, x = T.squeeze(F.col("text")), T.squeeze(F.col("line"))
    held = F.contains(x, q) | (~T.too_short(F.col("line")) & F.contains(q, x))
    return queries.join(lines, "doc_id").where(held)


def nearest(candidates: DataFrame, by: list[str], window: int) -> DataFrame:
    """Per query the candidate nearest to its pointer; backward ones count half a window more, of ties the first wins."""
    step = F.col("local_index") - F.col("pointer")
    far = F.when(step >= 0, step).otherwise(-step + window // 2)
    w = Window.partitionBy(*by).orderBy(far, "local_index")
    return candidates.withColumn("__place", F.row_number().over(w)).where("__place = 1").drop("__place")


def first_good(candidates: DataFrame, by: list[str], good: float = 0.9) -> DataFrame:
    """by, place, score: the first candidate by place above ``good``, else the first of the best."""
    early = F.min(F.when(F.col("score") > good, F.struct("place", "score")))
    best = F.max(F.struct("score", (-F.col("place")).alias("behind")))
    picked = candidates.groupBy(*by).agg(early.alias("early"), best.alias("best"))
    return picked.select(*by, F.coalesce("early.place", -F.col("best.behind")).alias("place"), F.coalesce("early.score", "best.score").alias("score"))


def length_penalty(part: Column, whole: Column, least: float = 0.03) -> Column:
    """1 from a length share of ``least`` on, below it in proportion, 0.1 at least."""
    share = F.length(T.strip(part)) / F.greatest(F.length(T.strip(whole)), F.lit(1))
    return F.when(share >= least, 1.0).otherwise(F.greatest(share / least, F.lit(0.1)))


def occurrence(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``occurrence``: how often the same line stood on its page before."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


# -- run statistics --------------------------------------------------------------------
def outcomes(runs: DataFrame, by: list[str]) -> DataFrame:
    """by, succeeded, failed from rows with a boolean ``ok``; null counts as failed."""
    ok = F.coalesce("ok", F.lit(False))
    return runs.groupBy(*by).agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"))


def epoch_means(steps: DataFrame) -> DataFrame:
    """epoch, key, mean: step scores averaged by epoch and key."""
    return steps.groupBy("epoch", "key").agg(F.avg("score").alias("mean"))


def metric_means(scores: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Plain means per metric: a NaN makes its mean NaN, no value at all does too, nulls are left out."""
    return scores.groupBy(*by).agg(*[F.coalesce(F.avg(m), F.lit(float("nan"))).alias(m) for m in metrics])


def valid_mean(value: Column) -> Column:
    """Mean over what is neither null nor NaN; null if there is nothing."""
    return F.avg(F.when(~F.isnan(value), value))


def with_missing_truth(counts: DataFrame, truth: DataFrame, by: str) -> DataFrame:
    """Counts (by, tp, predicted, truth) and a row for every group of ``truth`` (by, truth) that has no result."""
    lacking = truth.join(counts.select(by), by, "left_anti")
    return counts.unionByName(lacking.select(by, F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("predicted"), F.col("truth").cast("long").alias("truth")))


def truncated_pairs(predictions: Column, truths: Column) -> Column:
    """Array of (prediction, truth) as long as the shorter of the two arrays."""
    n = F.least(F.size(predictions), F.size(truths))
    return F.arrays_zip(F.slice(predictions, F.lit(1), n).alias("prediction"), F.slice(truths, F.lit(1), n).alias("truth"))


def by_position(base: DataFrame, fine: DataFrame) -> DataFrame:
    """Rows of two systems (idx, prediction, truth) side by side at equal positions; the longer one's tail is dropped."""
    a = base.select("idx", F.col("prediction").alias("base"), "truth")
    return a.join(fine.select("idx", F.col("prediction").alias("fine")), "idx")
