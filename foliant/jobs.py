"""Whole jobs over folders: ``python -m foliant.jobs NAME --help``.

Inputs are files that Spark reads from any store; outputs are Parquet, or JSON
lines where other programs read them.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import formulas as X
from foliant.functions import html as H
from foliant.functions import kernels as K
from foliant.functions import metrics as M
from foliant.functions import text as T
from foliant.operators import corpus as C
from foliant.operators import dataset as D
from foliant.operators import paging as G
from foliant.operators import scores as S
from foliant.sources import files as FS
from foliant.sources import records as R
from foliant.sources import text as ST

PAGE_TEXT = "paper_id string, page int, text string"
INDEX = "image string, paper_id string, page int, markdown string"
RESULTS = "predictions array<string>, ground_truths array<string>"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or nothing where there is none yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.parquet(path) if there else None


def markup(spark: SparkSession, html: str, out: str) -> None:
    """Every HTML file as markup."""
    FS.convert_folder(spark, html, out)


def pages(spark: SparkSession, html: str, page_text: str, out: str, recompute: bool = False) -> None:
    """Papers that have HTML and page text, split into pages; papers that ``out`` holds are left alone unless recomputed."""
    articles = FS.read_html(spark, html).select(C.stem_of(F.col("path")).alias("paper_id"), "html")
    done = None if recompute else _read(spark, out)
    if done is not None:
        articles = articles.join(done.select("paper_id").distinct(), "paper_id", "left_anti")
    lines = ST.page_lines(spark.read.schema(PAGE_TEXT).json(page_text).where("text IS NOT NULL"))
    both = articles.join(lines, "paper_id").withColumn("markup", K.column(H.to_markup, "string", F.col("html"))).where("markup <> ''")
    split = K.column(G.split_markup, "array<struct<text:string,valid:boolean>>", F.col("markup"), F.col("pages"))
    rows = both.select("paper_id", F.posexplode(split).alias("page", "p")).select("paper_id", "page", "p.text", "p.valid")
    rows.write.mode("overwrite" if recompute else "append").parquet(out)


def index(spark: SparkSession, pages: str, images: str, out: str) -> None:
    """JSON lines of the pages with text that are valid and have an image ``paper/page.png``."""
    held = spark.read.parquet(pages)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(images).select("path")
    parts = F.split("path", "/")
    found = found.select(F.element_at(parts, -2).alias("paper_id"), C.page_number(C.stem_of(F.col("path"))).cast("int").alias("page"), F.col("path").alias("image"))
    good = C.kept_pages(held, held.where("NOT valid"))
    rows = good.join(found, ["paper_id", "page"]).select("image", "paper_id", "page", F.col("text").alias("markdown"))
    R.write_json(rows.repartitionByRange("paper_id", "page").sortWithinPartitions("paper_id", "page"), out)


def split(spark: SparkSession, index: str, out: str, train: float = 0.8, validation: float = 0.1, seed: str = "42") -> None:
    """The index in three parts, whole papers at a time, as JSON lines under ``out``/train, validation and test."""
    rows = spark.read.schema(INDEX).json(index)
    parts = rows.join(D.split_papers(rows, "paper_id", train, validation, seed), "paper_id")
    for name in ("train", "validation", "test"):
        R.write_json(parts.where(F.col("split") == name).drop("split").select("image", "paper_id", "page", "markdown"), f"{out}/{name}")


def seek(spark: SparkSession, lines: str, out: str) -> None:
    """Byte offset of every line of every JSON lines file."""
    whole = spark.read.text(lines, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\n\z", "").alias("value"))
    rows = whole.select("file", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    D.offsets(rows, ["file"], "line_no", "line").select("file", "line_no", "offset").write.mode("overwrite").parquet(out)


def _scored(results: DataFrame) -> DataFrame:
    """One row: samples, means of NED and BLEU, micro scores of formulas."""
    rows = results.select("idx", *[T.normalised_for_eval(F.col(c)).alias(c) for c in ("prediction", "truth")])
    bleu = F.when(M.measured(F.col("prediction"), F.col("truth")), K.column(K.bleu4, "double", F.col("prediction"), F.col("truth")))
    means = rows.agg(F.count("*").alias("n_samples"), C.valid_mean(1 - M.edit_distance_share(F.col("prediction"), F.col("truth"))).alias("ned"), C.valid_mean(bleu).alias("bleu"))
    of = lambda c: rows.select("idx", F.explode(K.column(X.bodies, "array<string>", F.col(c))).alias("formula"))
    hits = S.multiset_hits(of("prediction"), of("truth"), ["idx"], "formula").withColumn("one", F.lit(1))
    prf = S.micro_prf(hits, ["one"]).select(*[F.col(c).alias(f"formula_{c}") for c in ("precision", "recall", "f1")])
    return means.join(prf, how="left")  # a row each


def evaluate(spark: SparkSession, base: str, out: str, fine: str = "") -> None:
    """Scores of one system, or of two and their differences; the longer one is cut to the shorter."""
    load = lambda path: R.result_rows(spark.read.schema(RESULTS).json(path))
    first = load(base)
    if not fine:
        return R.write_json(_scored(first), out)
    both = C.by_position(first, load(fine))
    a, b = (_scored(both.select("idx", F.col(c).alias("prediction"), "truth")) for c in ("base", "fine"))
    names = [c for c in a.columns if c != "n_samples"]
    pair = a.select("n_samples", *[F.col(c).alias(f"base_{c}") for c in names]).join(b.select(*[F.col(c).alias(f"fine_{c}") for c in names]))
    R.write_json(pair.select("*", *[(F.col(f"fine_{c}") - F.col(f"base_{c}")).alias(f"delta_{c}") for c in names]), out)


def tokens(spark: SparkSession, index: str, out: str) -> None:
    """Statistics of white-space tokens per page of an index."""
    n = spark.read.schema(INDEX).json(index).where("markdown IS NOT NULL").select(F.size(T.words(F.col("markdown"))).alias("n"))
    stats = [F.count("*").alias("n_pages"), F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), *[F.percentile("n", F.lit(q / 100)).alias(f"p{q}") for q in (50, 90, 95, 99)]]
    R.write_json(n.agg(*stats, *[F.count_if(F.col("n") > k).alias(f"over_{k}") for k in (1500, 2048, 4096)]), out)


JOBS = (markup, pages, index, split, seek, evaluate, tokens)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="foliant.jobs")
    commands = parser.add_subparsers(dest="job", required=True)
    for job in JOBS:
        command = commands.add_parser(job.__name__, help=inspect.getdoc(job))
        for name, p in list(inspect.signature(job).parameters.items())[1:]:
            if p.default is inspect.Parameter.empty:
                command.add_argument(name)
            elif p.default is False:
                command.add_argument(f"--{name}", action="store_true")
            else:
                command.add_argument(f"--{name}", type=type(p.default), default=p.default)
    options = vars(parser.parse_args(argv))
    name = options.pop("job")
    job = next(j for j in JOBS if j.__name__ == name)
    job(SparkSession.builder.getOrCreate(), **options)


if __name__ == "__main__":
    main()
