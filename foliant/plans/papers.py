"""Papers: sources, page index, figures, candidate lines, run statistics.  Files are stood in for by documents."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import kernels as K
from foliant.operators import corpus as C
from foliant.operators import dataset as D
from foliant.operators import lines as L
from foliant.sources import files as FS
from foliant.sources import records as R
from foliant.sources import text as ST

from .tables import LINES, document_lines, spread, table

#: File names by id mod 5; five documents are a paper.
_FILES = ["intro.tex", "ms.tex", "sections/main.tex", "appendix.tex", "paper.tex"]


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """paper_id, name, content: the documents of a paper as its files; some declare a class, some papers have one file."""
    docs = table(spark, sf_dir, "documents").where("doc_id % 35 < 31")
    name = F.element_at(F.array(*map(F.lit, _FILES)), (F.col("doc_id") % 5 + 1).cast("int"))
    head = F.when(F.col("doc_id") % 7 == 3, "\\documentclass{x}\\begin{document}").otherwise("")
    return docs.select(F.floor(F.col("doc_id") / 5).alias("paper_id"), name.alias("name"), F.concat(head, F.col("text")).alias("content"))


_FILES_SQL = f"""files AS (
  SELECT doc_id // 5 AS paper_id, ([{", ".join(f"'{x}'" for x in _FILES)}])[CAST(doc_id % 5 AS INT) + 1] AS name, CASE WHEN doc_id % 7 = 3 THEN '\\documentclass{{x}}\\begin{{document}}' ELSE '' END || text AS content
  FROM documents WHERE doc_id % 35 < 31
)"""


def main_file_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.main_tex(_files(spark, sf_dir))


MAIN_FILE_PICK = f"""
WITH {_FILES_SQL}
SELECT paper_id, name FROM files QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY
  CASE WHEN content LIKE '%\\documentclass%' AND content LIKE '%\\begin{{document}}%' THEN 0 ELSE coalesce(list_position(['main.tex', 'paper.tex', 'root.tex', 'manuscript.tex', 'ms.tex'], list_extract(string_split(name, '/'), -1)), 6) END, name) = 1"""


def bibliography_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir).withColumn("name", F.replace("name", F.lit(".tex"), F.lit(".bbl")))
    return C.bibliography_file(files)


BIBLIOGRAPHY_PICK = f"""
WITH {_FILES_SQL}, b AS (SELECT paper_id, replace(name, '.tex', '.bbl') AS name FROM files)
SELECT paper_id, name FROM b QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY CASE WHEN regexp_matches(name, '(^|/)main\\.bbl$') THEN 0 ELSE 1 END, name) = 1"""


def discovered_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers that an archive or a PDF stands for; dotted ids keep their dots."""
    docs = table(spark, sf_dir, "documents")
    arch = docs.where("doc_id % 3 = 0").select(F.concat(F.lit("in/"), F.lpad(F.col("doc_id").cast("string"), 4, "0"), F.lit(".13418"), F.when(F.col("doc_id") % 2 == 0, ".tar.gz").otherwise(".zip")).alias("path"))
    pdfs = docs.where("doc_id % 4 = 0").select(F.concat(F.lit("pdf/"), F.lpad(F.col("doc_id").cast("string"), 4, "0"), F.lit(".13418.pdf")).alias("path"))
    return C.discovered(arch, pdfs)


DISCOVERED_PAPERS = """
SELECT lpad(CAST(doc_id AS VARCHAR), 4, '0') || '.13418' AS paper_id FROM documents WHERE doc_id % 3 = 0
UNION SELECT lpad(CAST(doc_id AS VARCHAR), 4, '0') || '.13418' FROM documents WHERE doc_id % 4 = 0"""


def _zipped(doc_id: int, text: str | None) -> bytes:
    """A ZIP of two files; every ninth one is cut short."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("main.tex", text or "")
        z.writestr(f"sub/{doc_id}.bbl", f"bibliography {doc_id}")
    return held.getvalue()[:40] if doc_id % 9 == 4 else held.getvalue()


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an archive for each document; a broken archive is one row that says so."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    archives = docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("path"), K.column(_zipped, "binary", F.col("doc_id"), F.col("text")).alias("content"))
    return FS.members(archives).select("path", "name", FS.text_of(F.col("content")).alias("text"), F.col("error").isNotNull().alias("broken"))


ARCHIVE_MEMBERS = """
SELECT doc_id || '.zip' AS path, 'main.tex' AS name, coalesce(text, '') AS text, false AS broken FROM documents WHERE doc_id % 9 <> 4
UNION ALL SELECT doc_id || '.zip', 'sub/' || doc_id || '.bbl', 'bibliography ' || doc_id, false FROM documents WHERE doc_id % 9 <> 4
UNION ALL SELECT doc_id || '.zip', NULL, NULL, true FROM documents WHERE doc_id % 9 = 4"""


def html_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in normal form, no-break spaces and line breaks between tags put in."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", FS.normalised_html(F.replace(F.replace("html", F.lit("<p>"), F.lit("  \n\n <p>\u00a0")), F.lit("</h1>"), F.lit("&nbsp;</h1>"))).alias("html"))


HTML_NORMAL = r"""
SELECT page_id, regexp_replace(replace(replace(replace(replace(html, '<p>', E'  \n\n <p>' || chr(160)), '</h1>', '&nbsp;</h1>'), chr(160), ' '), '&nbsp;', ' '), '>[ \t\r]*\n\s*<', E'>\n<', 'g') AS html FROM pages"""


def cached_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under the key of their content, those that were recognised before from the cache, the others to be computed."""
    turns = table(spark, sf_dir, "conversations").select(F.md5(F.encode("text", "UTF-8")).alias("key"), "conv_id", "turn")
    cache = turns.where("conv_id % 3 = 0").select("key").distinct()
    known = turns.join(cache, "key", "left_semi").withColumn("cached", F.lit(True))
    return known.unionByName(turns.join(cache, "key", "left_anti").withColumn("cached", F.lit(False)))


CACHED_PAGES = "WITH t AS (SELECT md5(text) AS key, conv_id, turn FROM conversations) SELECT *, key IN (SELECT key FROM t WHERE conv_id % 3 = 0) AS cached FROM t"


def paper_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with HTML and PDF and their figure file, and how conversions ended, by whether figures must be computed."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("paper_id"), F.length("html").alias("size"))
    pdfs = table(spark, sf_dir, "documents").where("doc_id % 4 <> 1").select(F.col("doc_id").alias("paper_id"))
    figures = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("paper_id"), F.lit("figures.json").alias("figure_path")).distinct()
    held = C.paper_inputs(pages, pdfs, figures).withColumn("ok", F.when(F.col("size") > 3000, True).when(F.col("size") > 1500, False))
    return C.outcomes(held, ["to_compute"])


PAPER_INPUTS = """
WITH h AS (
  SELECT f.doc_id IS NULL AS to_compute, length(html) > 3000 AS ok FROM pages JOIN documents d ON d.doc_id = page_id AND d.doc_id % 4 <> 1 LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) f ON f.doc_id = page_id
)
SELECT to_compute, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed FROM h GROUP BY to_compute"""


# -- page index -----------------------------------------------------------------------
def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """paper_id, stem, page, text: conversations as papers, turns as pages; some stems are no numbers, some pages are blank."""
    stem = F.when(F.col("turn") % 6 == 5, "cover").otherwise(F.col("turn").cast("string"))
    text = F.when(F.col("turn") % 5 == 3, F.lit(" \n ")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("paper_id"), stem.alias("stem"), C.page_number(stem).alias("page"), text.alias("text"))


_PAGES = """pages_ AS (
  SELECT conv_id AS paper_id, CASE WHEN turn % 6 = 5 THEN 'cover' ELSE CAST(turn AS VARCHAR) END AS stem, CASE WHEN turn % 6 = 5 THEN 0 ELSE turn END AS page, turn,
    CASE WHEN turn % 5 = 3 THEN '' ELSE text END AS text FROM conversations
)"""


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with text that are not faulty, have an image and metadata, in order of paper and page."""
    pages = _pages(spark, sf_dir)
    bad = pages.where("paper_id % 7 = 2 AND page = 1").select("paper_id", "page")
    images = pages.where("paper_id % 3 <> 1").select("paper_id", "page")
    meta = table(spark, sf_dir, "conversations").where("turn < 4").select(F.col("conv_id").alias("paper_id"), F.col("turn").alias("page"), F.col("role").alias("meta"))
    out = C.indexed_pages(C.kept_pages(pages, bad), images, meta)
    return out.select("paper_id", "page", "stem", "meta").orderBy("paper_id", "page", "stem")


PAGE_INDEX = f"""
WITH {_PAGES}
SELECT p.paper_id, p.page, stem, c.role AS meta FROM pages_ p JOIN conversations c ON c.conv_id = p.paper_id AND c.turn = p.page AND c.turn < 4
WHERE p.text <> '' AND NOT (p.paper_id % 7 = 2 AND p.page = 1) AND p.paper_id % 3 <> 1"""


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased, non-blank lines of page texts with ligatures put in; how often each stood on its page before."""
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.lit(0).alias("page"), F.concat(F.lit(" ﬁrst Æ\n\n"), "text", F.lit("\nﬁrst Æ \n\t\n")).alias("text"))
    return C.occurrence(ST.lower_lines(pages), ["paper_id", "page", "line"], ["line_no"])


PAGE_LINES = rf"""
WITH l AS (
  SELECT doc_id AS paper_id, list_filter(list_transform(string_split(replace(replace(replace(' first AE' || E'\n\n' || text || E'\n' || 'first AE ' || E'\n\t\n', 'œ', 'oe'), 'æ', 'ae'), 'Œ', 'OE'), E'\n'), lambda x: lower(trim(x, E' \t\r'))), lambda x: x <> '') AS l FROM documents
), u AS (SELECT paper_id, 0 AS page, unnest(l) AS line, unnest(generate_series(0, len(l) - 1)) AS line_no FROM l)
SELECT paper_id, page, CAST(line_no AS INT) AS line_no, line, CAST(row_number() OVER (PARTITION BY paper_id, page, line ORDER BY line_no) - 1 AS INT) AS occurrence FROM u"""


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of page texts without blanks at line ends and hyphens."""
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.lit(0).alias("page"), F.concat(F.lit("a ﬂow-  \nchart of\n\n\n\n"), F.replace("text", F.lit("-"), F.lit("+"))).alias("text"))
    return ST.paragraphs(pages)


PARAGRAPHS = rf"""
WITH x AS (
  SELECT doc_id AS paper_id, array_to_string(list_transform(string_split(replace(text, '-', '+'), E'\n'), lambda x: rtrim(x, E' \t\r')), E'\n') AS t FROM documents
), p AS (SELECT paper_id, string_split(regexp_replace('a flowchart' || E'\n' || ' of' || E'\n\n\n\n' || t, '\n{{3,}}', E'\n\n', 'g'), E'\n\n') AS p FROM x)
SELECT paper_id, 0 AS page, CAST(unnest(generate_series(0, len(p) - 1)) AS INT) AS paragraph_no, unnest(p) AS paragraph FROM p"""


def jsonl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of pages, every ninth broken; those that parse and whose image exists."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(F.struct(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("image"), F.col("text").alias("markdown"))).alias("line"))
    lines = rows.withColumn("line", F.when(F.col("turn") % 9 == 4, F.expr("substring(line, 1, 12)")).otherwise(F.col("line")))
    good = R.parsed_lines(lines, "image string, markdown string")
    images = table(spark, sf_dir, "conversations").where("conv_id % 2 = 0").select(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("image"))
    return good.join(images, "image", "left_semi")


JSONL_ROWS = "SELECT conv_id, turn, conv_id || '/' || turn AS image, text AS markdown FROM conversations WHERE turn % 9 <> 4 AND conv_id % 2 = 0"


# -- figures --------------------------------------------------------------------------------
def page_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as figures of orders: pixel boxes of figures on pages in range, the names on each page, and whether a mention by number is valid."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct((F.col("l_linenumber") - 1).cast("int").alias("page"), F.concat(F.lit("Figure "), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_quantity").cast("double").alias("x1"), F.lit(10.5).alias("y1"), (F.col("l_quantity") + 72).cast("double").alias("x2"), F.lit(20.0).alias("y2"))
    papers = li.groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.lit(4).alias("n_pages"), F.collect_list(item).alias("figures"))
    found = C.figures_of_pages(papers)
    names = C.figure_names(found)
    mentions = li.select(F.col("l_orderkey").alias("paper_id"), (F.col("l_linenumber") - 1).alias("page"), F.concat(F.lit("Figure "), (F.col("l_linenumber") + F.col("l_suppkey") % 2).cast("string")).alias("name"))
    valid = C.valid_figures(mentions, found).select("paper_id", "page", C.figure_number(F.col("name")).alias("valid")).distinct()
    return found.join(names, ["paper_id", "page"]).join(valid, ["paper_id", "page"], "left").select("paper_id", "page", "name", "x1", "x2", "y1", F.array_join("names", ",").alias("names"), "valid")


PAGE_FIGURES = """
WITH f AS (
  SELECT l_orderkey AS paper_id, CAST(l_linenumber - 1 AS INT) AS page, 'Figure ' || l_linenumber AS name, CAST(round_even(CAST(l_quantity AS DOUBLE) * 96 / 72, 0) AS BIGINT) AS x1, CAST(round_even((CAST(l_quantity AS DOUBLE) + 72) * 96 / 72, 0) AS BIGINT) AS x2, CAST(14 AS BIGINT) AS y1
  FROM lineitem WHERE l_linenumber <= 4
), n AS (SELECT paper_id, page, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM f GROUP BY ALL), m AS (
  SELECT DISTINCT l_orderkey AS paper_id, CAST(l_linenumber - 1 AS INT) AS page, 'Figure ' || (l_linenumber + l_suppkey % 2) AS name FROM lineitem
), v AS (SELECT paper_id, page, regexp_extract(name, '[0-9]+$') AS valid FROM m WHERE EXISTS (SELECT 1 FROM f WHERE f.paper_id = m.paper_id AND f.page = m.page AND f.name = m.name))
SELECT f.*, names, valid FROM f JOIN n USING (paper_id, page) LEFT JOIN v USING (paper_id, page)"""


def title_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents; those that are the title of an object, here a line that stands more than once, give way to it."""
    lines = document_lines(spark, sf_dir).where("trim(line) <> ''").select("doc_id", "line_no", F.trim("line").alias("line"))
    objects = L.repeated(document_lines(spark, sf_dir)).select(F.col("line").alias("title"), F.concat(F.lit("object "), F.col("n").cast("string")).alias("object"))
    return C.with_objects(lines, objects)


TITLE_OBJECTS = f"""
WITH {LINES}, l AS (SELECT doc_id, CAST(line_no AS INT) AS line_no, trim(line) AS line FROM lines WHERE trim(line) <> ''), r AS (SELECT line AS title, 'object ' || count(*) AS object FROM l GROUP BY line HAVING count(*) > 1)
SELECT doc_id, line_no, coalesce(object, line) AS line FROM l LEFT JOIN r ON title = line"""


# -- candidates ---------------------------------------------------------------------------------
def _queries_and_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every third line of a document, cut at both ends, as a query at a pointer of half its number; the document's lines."""
    lines = document_lines(spark, sf_dir).where("trim(line) <> ''").withColumn("local_index", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")) - 1)
    own = lines.where("local_index % 3 = 0 AND length(line) > 40")
    return own.select("doc_id", F.col("local_index").alias("query"), F.floor(F.col("local_index") / 2).alias("pointer"), F.substring("line", 5, 24).alias("text")), lines.select("doc_id", "local_index", "line")


_QUERIES = f"""{LINES}, l AS (SELECT doc_id, line, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS INT) AS local_index FROM lines WHERE trim(line) <> ''),
q AS (SELECT doc_id, local_index AS query, local_index // 2 AS pointer, substr(line, 5, 24) AS text FROM l WHERE local_index % 3 = 0 AND length(line) > 40)"""


def band_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines lie in each query's forward band, and in the band to both sides."""
    queries, lines = _queries_and_lines(spark, sf_dir)
    near = C.band(queries, lines, 20, 20).groupBy("doc_id", "query").agg(F.count("*").alias("both"), F.count_if(F.col("local_index") >= F.col("pointer")).alias("ahead"))
    only = C.band(queries, lines, 20).groupBy("doc_id", "query").agg(F.count("*").alias("forward"))
    return near.join(only, ["doc_id", "query"])


BAND_LINES = f"""
WITH {_QUERIES}
SELECT q.doc_id, q.query, count(*) AS both, count(*) FILTER (l.local_index >= pointer) AS ahead, count(*) FILTER (l.local_index >= pointer) AS forward
FROM q JOIN l ON l.doc_id = q.doc_id AND l.local_index BETWEEN pointer - 20 AND pointer + 20 GROUP BY ALL"""


def nearest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest line that holds each query."""
    queries, lines = _queries_and_lines(spark, sf_dir)
    return C.nearest(C.containing(queries, lines), ["doc_id", "query"], 20).select("doc_id", "query", "local_index")


_TIGHT = "replace(replace(replace({c}, E'\\t', ''), chr(160), ''), ' ', '')"
NEAREST_LINES = f"""
WITH {_QUERIES}, t AS (SELECT *, {_TIGHT.format(c="line")} AS x FROM l), c AS (
  SELECT q.doc_id, query, local_index, pointer FROM q JOIN t ON t.doc_id = q.doc_id WHERE contains(x, {_TIGHT.format(c="text")}) OR length(x) > 8 AND contains({_TIGHT.format(c="text")}, x)
)
SELECT doc_id, query, local_index FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, query ORDER BY CASE WHEN local_index >= pointer THEN local_index - pointer ELSE pointer - local_index + 10 END, local_index) = 1"""


def early_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order's items the first with a score above 0.9, else the best."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("place"), (F.col("l_partkey") % 97 / 96).alias("score"))
    return C.first_good(li, ["l_orderkey"]).select("l_orderkey", "place", F.round("score", 6).alias("score"))


EARLY_PICKS = """
WITH s AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS place, l_partkey % 97 / 96 AS score FROM lineitem)
SELECT l_orderkey, place, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN score > 0.9 THEN 0 ELSE 1 END, CASE WHEN score > 0.9 THEN place ELSE -score END, place) = 1"""


def boundary_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries of each order, items by place and kind; and their labels by height."""
    li = table(spark, sf_dir, "lineitem")
    marks = F.array_sort(F.collect_list(F.struct((F.col("l_partkey") % 5).alias("start"), F.when(F.col("l_suppkey") % 2 == 0, "first").otherwise("last").alias("kind"), "l_linenumber")))
    seen = F.array_sort(F.collect_list(F.struct((F.col("l_partkey") * 7 % 700).alias("y"), "l_linenumber")))
    out = li.groupBy("l_orderkey").agg(marks.alias("m"), seen.alias("v"))
    show = lambda c, f: F.array_join(F.transform(c, f), " ")
    return out.select("l_orderkey", show("m", lambda m: F.concat(m["start"].cast("string"), m["kind"])).alias("marks"), show("v", lambda v: v["l_linenumber"].cast("string")).alias("by_height"))


BOUNDARY_ORDER = """
SELECT l_orderkey, string_agg((l_partkey % 5) || CASE WHEN l_suppkey % 2 = 0 THEN 'first' ELSE 'last' END, ' ' ORDER BY l_partkey % 5, CASE WHEN l_suppkey % 2 = 0 THEN 'first' ELSE 'last' END, l_linenumber) AS marks,
  string_agg(CAST(l_linenumber AS VARCHAR), ' ' ORDER BY l_partkey * 7 % 700, l_linenumber) AS by_height FROM lineitem GROUP BY l_orderkey"""


# -- run statistics -----------------------------------------------------------------------------
def epoch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals as step scores, years as epochs, priorities as keys."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("epoch"), F.col("o_orderpriority").alias("key"), F.col("o_totalprice").alias("score"))
    return C.epoch_means(o).select("epoch", "key", F.round("mean", 2).alias("mean"))


EPOCH_SCORES = "SELECT CAST(year(o_orderdate) AS INT) AS epoch, o_orderpriority AS key, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY ALL"


def split_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of every split in order of their ids, with their samples' count."""
    samples = table(spark, sf_dir, "conversations")
    sizes = samples.groupBy("conv_id").agg(F.count("*").alias("samples"))
    return D.split_papers(samples, "conv_id").join(sizes, "conv_id").groupBy("split").agg(F.array_sort(F.collect_list(F.struct("conv_id", "samples"))).alias("p")).select("split", F.posexplode("p").alias("place", "p")).select("split", "place", "p.conv_id", "p.samples")


SPLIT_LISTS = """
WITH p AS (SELECT conv_id, count(*) AS samples, md5('42:' || conv_id) AS h FROM conversations GROUP BY conv_id), o AS (SELECT *, row_number() OVER (ORDER BY h, conv_id) AS k, count(*) OVER () AS total FROM p), s AS (
  SELECT *, CASE WHEN k <= floor(0.8 * total) THEN 'train' WHEN k <= floor(0.8 * total) + floor(0.1 * total) THEN 'validation' ELSE 'test' END AS split FROM o
)
SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY conv_id) - 1 AS INT) AS place, conv_id, samples FROM s"""


def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred samples in order, as a sample limit takes them; and the matched lines over all of them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").orderBy("conv_id", "turn").limit(100)
    return turns


FIRST_SAMPLES = "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 100"


def matched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct document lines that any page line matched, and papers sorted in their split."""
    queries, lines = _queries_and_lines(spark, sf_dir)
    return C.containing(queries, lines).select("doc_id", "local_index").distinct()


MATCHED_LINES = f"""
WITH {_QUERIES}, t AS (SELECT *, {_TIGHT.format(c="line")} AS x FROM l)
SELECT DISTINCT q.doc_id, local_index FROM q JOIN t ON t.doc_id = q.doc_id WHERE contains(x, {_TIGHT.format(c="text")}) OR length(x) > 8 AND contains({_TIGHT.format(c="text")}, x)"""

_NAMES = "archive_members html_normal cached_pages split_lists main_file_pick bibliography_pick discovered_papers paper_inputs page_index page_lines paragraphs jsonl_rows page_figures title_objects band_lines nearest_lines early_picks boundary_order epoch_scores first_samples matched_lines".split()
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
