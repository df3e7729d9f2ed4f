"""Archives, HTML pages, PDF lists and external converters."""

from __future__ import annotations

import io
import subprocess
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of one archive member that are read; larger ones are reported, not read.
MEMBER_BYTES = 1 << 28
MEMBERS = "path string, name string, content binary, error string"


def _safe(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return bool(name) and not name.startswith("/") and ".." not in parts


def _members(path: str, content: bytes) -> Iterator[tuple[str, str | None, bytes | None, str | None]]:
    try:
        if path.lower().endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for i in z.infolist():
                    if not i.is_dir() and _safe(i.filename):
                        yield (path, i.filename, None, "too large") if i.file_size > MEMBER_BYTES else (path, i.filename, z.read(i), None)
        else:
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as t:
                for i in t:
                    if i.isreg() and _safe(i.name):
                        yield (path, i.name, None, "too large") if i.size > MEMBER_BYTES else (path, i.name, t.extractfile(i).read(), None)
    except (tarfile.TarError, zipfile.BadZipFile, OSError, EOFError, ValueError, RuntimeError) as e:
        yield path, None, None, f"{type(e).__name__}: {e}"


def members(archives: DataFrame) -> DataFrame:
    """path, name, content, error: regular files of zip and tar archives (path, content).

    Names that lead out of the archive, links and devices are left out.  A broken
    archive gives one row with its error; members read before it stay.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for row in _members(path, b"" if content is None else bytes(content)):
                    yield pd.DataFrame([row], columns=["path", "name", "content", "error"])

    return archives.select("path", "content").mapInPandas(run, MEMBERS)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Members of all archives below a folder."""
    held = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{zip,tar,tgz,gz}").load(folder)
    return members(held)


def text_of(content: Column) -> Column:
    """Bytes as text; bytes that are no UTF-8 become replacement characters."""
    return F.make_valid_utf8(content.cast("string"))


def normalised_html(html: Column) -> Column:
    """One form of white space: no-break spaces as blanks, runs between tags that hold a line break as one break."""
    plain = F.replace(F.replace(html, F.lit("\u00a0"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))
    return F.regexp_replace(plain, r">[ \t\r]*\n\s*<", ">\n<")


def read_html(spark: SparkSession, folder: str) -> DataFrame:
    """path, html of every HTML file below a folder, in normal form."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{html,htm}").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), normalised_html(F.col("value")).alias("html"))


def list_pdfs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, length of the PDFs that arguments name: folders are searched through, files and patterns taken as they are."""
    held = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(paths)
    return held.select("path", "length")


RUN = "paper_id string, returncode int, output string, timed_out boolean"


def run_external(tasks: DataFrame, seconds: float) -> DataFrame:
    """paper_id, returncode, output, timed_out of one command line per row (paper_id, command array).

    For converters that are not ours: figure extraction (30 s), TeX conversion
    (300 s a step), rasterising.  A command that is missing or runs too long is a
    row, not an error.  A lost executor runs its rows again, so commands must be repeatable.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for paper, command in zip(batch["paper_id"], batch["command"], strict=True):
                try:
                    done = subprocess.run(list(command), capture_output=True, timeout=seconds, check=False)
                    out.append((paper, done.returncode, (done.stdout or done.stderr).decode("utf-8", "replace"), False))
                except subprocess.TimeoutExpired:
                    out.append((paper, None, None, True))
                except OSError as e:
                    out.append((paper, None, str(e), False))
            frame = pd.DataFrame(out, columns=["paper_id", "returncode", "output", "timed_out"])
            yield frame.astype({"returncode": "Int32"})

    return tasks.select("paper_id", "command").mapInPandas(run, RUN)


def figure_command(pdf: Column, jar: str, out: str) -> Column:
    """Command line of the figure extractor."""
    return F.array(F.lit("java"), F.lit("-jar"), F.lit(jar), pdf, F.lit("-d"), F.lit(out))


def tex_commands(tex: Column, xml: Column, html: Column) -> tuple[Column, Column]:
    """Command lines of the two conversion steps."""
    return F.array(F.lit("latexml"), F.concat(F.lit("--destination="), xml), tex), F.array(F.lit("latexmlpost"), F.lit("--format=html5"), F.concat(F.lit("--destination="), html), xml)


def raster_command(pdf: Column, out: Column, dpi: int, first: Column, last: Column) -> Column:
    """Command line that renders pages first to last at ``dpi``."""
    return F.array(F.lit("pdftoppm"), F.lit("-png"), F.lit("-r"), F.lit(str(dpi)), F.lit("-f"), first.cast("string"), F.lit("-l"), last.cast("string"), pdf, out)


def convert_folder(spark: SparkSession, source: str, target: str) -> None:
    """Every HTML file below ``source`` as markup under its stem, in Parquet; files without an article are left out."""
    from foliant.functions import html as H
    from foliant.functions import kernels as K
    from foliant.operators.corpus import stem_of

    markup = K.column(H.to_markup, "string", F.col("html"))
    read_html(spark, source).select(stem_of(F.col("path")).alias("name"), markup.alias("markup")).where("markup <> ''").write.mode("overwrite").parquet(target)
