"""JSON lines, results, indexes and annotation XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import corpus as C

#: Scores from which detections go into a table file.
TABLE_SCORE = 0.7
CORRUPT = "_corrupt_record"
FIGURES = "paper_id string, figures array<struct<name:string,figType:string,page:int,caption:string,regionBoundary:struct<x1:double,y1:double,x2:double,y2:double>>>"


def write_index(pages: DataFrame, faulty: DataFrame, path: str) -> None:
    """The page index as JSON lines; papers without pages and faulty papers are left out."""
    pages.join(faulty.select("paper_id"), "paper_id", "left_anti").write.mode("overwrite").json(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON line a row: results of a system, figures, any record."""
    rows.write.mode("overwrite").json(path)


def write_with_debug(rows: DataFrame, path: str, debug: str | None) -> None:
    """Rows as Parquet, and the texts before and after splitting as JSON lines where a debug folder is named."""
    rows.write.mode("overwrite").parquet(path)
    if debug is not None:
        rows.sparkSession.read.parquet(path).write.mode("overwrite").json(debug)


def read_jsonl(spark: SparkSession, path: str, schema: str, images: DataFrame | None = None, image: str = "image") -> DataFrame:
    """Records of JSON lines that parse and, if ``images`` (path) are given, whose image exists; others are left out."""
    rows = spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    good = parsed_only(rows)
    return good if images is None else good.join(images.select(F.col("path").alias(image)), image, "left_semi")


def parsed_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def parsed_lines(lines: DataFrame, schema: str, line: str = "line") -> DataFrame:
    """Lines that parse as ``schema``, their fields beside all other columns; broken lines are left out."""
    parsed = F.from_json(line, f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    held = lines.withColumn("__r", parsed).where(F.col("__r").isNotNull() & F.col(f"__r.{CORRUPT}").isNull())
    return held.select(*[c for c in lines.columns if c != line], "__r.*").drop(CORRUPT)


def at_offsets(lines: DataFrame, seek: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines at wanted (file, offset) places, by the seek map (file, line_no, offset)."""
    return wanted.join(seek, ["file", "offset"]).join(lines, ["file", "line_no"])


def split_path(stem: str, split: str, template: str = "%s") -> str:
    """The file stem of a split: the stem itself if it names the split, else the template filled; anything else is an error."""
    if split in stem:
        return stem
    if "%s" not in template:
        raise ValueError(f"no split {split!r} in {stem!r}, and no place for it in {template!r}")
    return template % split


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """Figure records of the extractor's JSON files."""
    return spark.read.schema(FIGURES).option("multiLine", "true").json(path)


def result_rows(results: DataFrame) -> DataFrame:
    """idx, prediction, truth of results (predictions, ground_truths), cut to the shorter of both."""
    pairs = C.truncated_pairs(F.col("predictions"), F.col("ground_truths"))
    others = [c for c in results.columns if c not in ("predictions", "ground_truths")]
    return results.select(*others, F.posexplode(pairs).alias("idx", "p")).select(*others, "idx", "p.prediction", "p.truth")


def results_of(rows: DataFrame, by: list[str]) -> DataFrame:
    """One record a system: predictions and ground truths in order of idx."""
    held = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("idx", "prediction", "truth"))).alias("r"))
    return held.select(*by, F.transform("r", lambda r: r["prediction"]).alias("predictions"), F.transform("r", lambda r: r["truth"]).alias("ground_truths"))


def table_xml(boxes: DataFrame) -> DataFrame:
    """page_id, xml: tables found with TABLE_SCORE or more, as four corners each, in order of their ids; whole pixels."""
    x, y, w, h = (c.cast("int") for c in (F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    points = F.concat_ws(" ", *[F.concat_ws(",", a, b) for a, b in ((x, y), (x, y + h), (x + w, y + h), (x + w, y))])
    tables = boxes.where(F.col("score") >= TABLE_SCORE).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("box_id", points.alias("points")))).alias("t"))
    parts = F.transform("t", lambda t, i: F.concat(F.lit('<table id="'), i + 1, F.lit('"><Coords points="'), t["points"], F.lit('"/></table>')))
    head = F.format_string('<document filename="cTDaR_t%05d.jpg">', "page_id")
    return tables.select("page_id", F.concat(head, F.array_join(parts, ""), F.lit("</document>")).alias("xml"))


#: What an annotation file says of its objects, as text.
VOC = "object array<struct<name:string,bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>>>"


def voc_objects(files: DataFrame) -> DataFrame:
    """Columns of ``files`` but xml, and label, x1, y1, x2, y2 of every object of an annotation file; broken files have none.

    A file is parsed once.
    """
    kept = [c for c in files.columns if c != "xml"]
    held = files.where(F.col("xml").rlike(r"(?s)^\s*<(\?xml.*?\?>\s*<)?annotation\b.*</annotation>\s*\z"))
    parsed = F.from_xml("xml", VOC, {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"})
    rows = held.select(*kept, F.explode(parsed["object"]).alias("o"))
    return rows.select(*kept, F.col("o.name").alias("label"), *[F.col(f"o.bndbox.{c}").cast("double").alias(n) for n, c in zip(("x1", "y1", "x2", "y2"), ("xmin", "ymin", "xmax", "ymax"), strict=True)])


def voc_xml(boxes: DataFrame) -> DataFrame:
    """page_id, xml: an annotation file of each page's boxes, in order of their ids."""
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    number = lambda c: F.col(c).cast("int").cast("string")
    box = F.concat(*[tag(n, number(c)) for n, c in (("xmin", "x1"), ("ymin", "y1"), ("xmax", "x2"), ("ymax", "y2"))])
    item = tag("object", F.concat(tag("name", F.col("label")), tag("bndbox", box)))
    held = boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("box_id", item.alias("x")))).alias("o"))
    return held.select("page_id", tag("annotation", F.array_join(F.transform("o", lambda o: o["x"]), "")).alias("xml"))
