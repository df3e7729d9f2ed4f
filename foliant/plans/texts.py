"""Markup of pages, its lines and its split into pages; TeX, formulas and generated text."""

from __future__ import annotations

import re
import textwrap

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import formulas as X
from foliant.functions import html as H
from foliant.functions import kernels as K
from foliant.functions import markup as M
from foliant.functions import postprocess as P
from foliant.functions import tex as TX
from foliant.functions import text as T
from foliant.operators import paging as G
from foliant.sources import files as FS

from .tables import dealt, table


def _pick(choices: list[str], key: str = "doc_id") -> Column:
    """One of the texts, by the key's remainder."""
    return F.element_at(F.array(*map(F.lit, choices)), (F.col(key) % len(choices) + 1).cast("int"))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


# -- pages ----------------------------------------------------------------------------------
#: LaTeXML forms put in front of each article's end, by page id.
_EXTRA = [
    '<p>see <a class="ltx_ref" href="#bib.bib7">Smith2:2019</a> and <cite>1, 2</cite> x<sup>2</sup><span class="ltx_note_outer"><span class="ltx_note_content"><sup class="ltx_note_mark">3</sup>a note</span></span></p>',
    '<section><h2 class="ltx_title"><span class="ltx_tag ltx_tag_section">1 </span>Title</h2><p>body <math class="ltx_Math" alttext="a\\le b" display="inline"></math></p></section>',
    '<figure class="ltx_figure" id="S1.F1"><figcaption class="ltx_caption">Figure 1: a caption</figcaption></figure>',
    '<figure class="ltx_table" id="T1"><table class="ltx_tabular"><tbody class="ltx_tbody"><tr class="ltx_tr"><td class="ltx_td ltx_align_left ltx_border_t" rowspan="2">a_b</td><td class="ltx_td ltx_align_right">1</td></tr><tr class="ltx_tr"><td class="ltx_td ltx_align_right">2</td></tr></tbody></table></figure>',
    '<ul class="ltx_itemize"><li class="ltx_item">one<ol class="ltx_enumerate"><li class="ltx_item">two</li></ol></li></ul><section class="ltx_bibliography"><ul class="ltx_biblist"><li class="ltx_bibitem" id="bib.bib1"><span class="ltx_tag ltx_tag_bibitem">[1]</span> An entry</li></ul></section>',
]


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, html with a LaTeXML form in it; pages come in normal form."""
    pages = dealt(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", F.replace(FS.normalised_html(F.col("html")), F.lit("</article>"), F.concat(_pick(_EXTRA, "page_id"), F.lit("</article>"))).alias("html"))


def _markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html(spark, sf_dir).select("page_id", K.column(H.to_markup, "string", F.col("html")).alias("markup"))


def _article(html: str | None) -> tuple:
    """Markup of a page's article, its bibliography items and the names of its floats."""
    markup, references = H.to_markup(html), H.bibliography(html)
    names = None if markup is None else ",".join(sorted(H.floats(markup)))
    return markup, None if references is None else "\n".join(x for x in references if x is not None), names


def html_to_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_article`` of every page: one kernel, as every kernel of a task has a worker of its own."""
    pages = _html(spark, sf_dir).select("page_id", K.column(_article, "struct<markup:string,references:string,floats:string>", F.col("html")).alias("a"))
    return pages.select("page_id", "a.*")


def text_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space of text nodes, and their text escaped for TeX; documents with blanks and special characters put in."""
    put = [" \n ", "\n\n a\t\tb \n\n", "x & 5% $1 #2 a_b {c} ~ ^ \\ <d>\n\n", " \t "]
    docs = _docs(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 8 < 4, _pick(put)).otherwise(F.concat(_pick(put), F.col("text"))))
    return docs.select("doc_id", T.squeezed_node(F.col("text")).alias("node"), T.tex_escaped(F.col("text")).alias("escaped"))


_PRIVATE = "".join(chr(0xE000 + k) for k in range(len(T.ESCAPES)))
_ESCAPED = "replace(" * len(T.ESCAPES) + "translate(x, '" + "".join(T.ESCAPES) + f"', '{_PRIVATE}')" + "".join(f", '{p}', '{v}')" for p, v in zip(_PRIVATE, T.ESCAPES.values(), strict=True))
TEXT_NODES = (
    r"""
WITH p AS (SELECT doc_id, ([E' \n ', E'\n\n a\t\tb \n\n', E'x & 5% $1 #2 a_b {c} ~ ^ \\ <d>\n\n', E' \t '])[CAST(doc_id % 4 AS INT) + 1] || CASE WHEN doc_id % 8 < 4 THEN '' ELSE text END AS x FROM documents)
SELECT doc_id, regexp_replace(CASE WHEN trim(x, E' \t\n\r') <> '' THEN regexp_replace(regexp_replace(x, '^\n+', E'\n'), '\n+$', E'\n') ELSE trim(x, E'\n') END, '[ \t]+', ' ', 'g') AS node, """
    + _ESCAPED
    + " AS escaped FROM p"
)


def markup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every page's markup with tag and match text, and how many float objects it has; an author block and a nested text tag put in."""
    put = "[AUTHOR]\nA. One\n[FOOTNOTE:1]1mail[END_FOOTNOTE]\n B. Two\n[END_AUTHOR]\n[TEXT]a[TEXT]b[END_TEXT]\\pagebreak c[END_TEXT]\n[ALGORITHM]\n[ALGORITHM_TITLE]alg[END_ALGORITHM_TITLE]\n```\nx\n```\n[END_ALGORITHM]\n"

    def run(html: str | None) -> dict | None:
        markup = H.to_markup(html)
        if markup is None:
            return None
        got = M.parsed(put + markup)
        return {"objects": len(got.objects), "lines": [{"line": x, "tag": t, "match": M.match_text(x, t)} for x, t in zip(got.lines, got.tags, strict=True)]}

    parsed = K.column(run, "struct<objects:int,lines:array<struct<line:string,tag:string,match:string>>>", F.col("html"))
    rows = _html(spark, sf_dir).select("page_id", parsed.alias("p"))
    return rows.select("page_id", "p.objects", F.posexplode("p.lines").alias("line_no", "l")).select("page_id", "objects", "line_no", "l.*")


def plain_pages(markup: str | None, width: int = 70, height: int = 12) -> list[list[str]] | None:
    """What a page's text would be if the markup were printed: tags away, lines of ``width``, pages of ``height`` lines, each with its number."""
    if markup is None:
        return None
    bare = re.sub(r"\[/?[A-Z_]+(?::[^\]]*)?\]", "", markup)
    lines = [x.lower() for part in bare.split("\n") for x in textwrap.wrap(part, width)]
    return [[*lines[k : k + height], str(k // height + 1)] for k in range(0, len(lines), height)]


def split_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's markup split into the pages of its printed text."""

    def run(html: str | None) -> list | None:
        markup = H.to_markup(html)
        return G.split_markup(markup, plain_pages(markup))

    split = K.column(run, "array<struct<text:string,valid:boolean>>", F.col("html"))
    return _html(spark, sf_dir).select("page_id", F.posexplode(split).alias("page", "p")).select("page_id", "page", "p.text", "p.valid")


def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First pages whose missing title, author and abstract tags follow what a detector saw."""
    head = ["[TEXT]A title[END_TEXT]\n[TEXT]A. One[END_TEXT]\n[TEXT]abstract[END_TEXT]", "[TITLE]A title[END_TITLE]\n[TEXT]A. One[END_TEXT]\n[TEXT]abstract[END_TEXT]", "no tags", "[TITLE:1]A title[END_TITLE]\n[AUTHOR]A[END_AUTHOR]\n [TEXT]abstract[END_TEXT]"]
    seen = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("title"), F.lit("author"))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("文章标题"), F.lit("assistant_title"), F.lit("作者"), F.lit("?"))).otherwise(F.array().cast("array<string>"))
    kernel = lambda page, labels: M.corrected_first_page(page, labels, frozenset({"TITLE", "AUTHOR", "ABSTRACT"}))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(_pick(head), F.lit("\n"), F.substring("text", 1, 20)).alias("page"), seen.alias("seen"))
    return docs.select("doc_id", K.column(kernel, "string", F.col("page"), F.col("seen")).alias("page"))


FIRST_PAGES = """
WITH p AS (SELECT doc_id, doc_id % 4 AS k, doc_id % 3 AS s, E'\\n' || substr(text, 1, 20) AS t FROM documents)
SELECT doc_id, CASE
  WHEN k = 0 AND s = 0 THEN E'[TITLE]A title[END_TITLE]\\n[AUTHOR]A. One[END_AUTHOR]\\n[TEXT]abstract[END_TEXT]' WHEN k = 0 AND s = 1 THEN E'[TITLE]A title[END_TITLE]\\n[AUTHOR]A. One[END_AUTHOR]\\n[ABSTRACT]abstract[END_ABSTRACT]'
  WHEN k = 0 THEN E'[TEXT]A title[END_TEXT]\\n[TEXT]A. One[END_TEXT]\\n[TEXT]abstract[END_TEXT]'
  WHEN k = 1 AND s = 0 THEN E'[TITLE]A title[END_TITLE]\\n[AUTHOR]A. One[END_AUTHOR]\\n[TEXT]abstract[END_TEXT]' WHEN k = 1 AND s = 1 THEN E'[TITLE]A title[END_TITLE]\\n[AUTHOR]A. One[END_AUTHOR]\\n[ABSTRACT]abstract[END_ABSTRACT]'
  WHEN k = 1 THEN E'[TITLE]A title[END_TITLE]\\n[TEXT]A. One[END_TEXT]\\n[TEXT]abstract[END_TEXT]' WHEN k = 2 THEN 'no tags'
  WHEN s = 1 THEN E'[TITLE:1]A title[END_TITLE]\\n[AUTHOR]A[END_AUTHOR]\\n[ABSTRACT]abstract[END_ABSTRACT]' ELSE E'[TITLE:1]A title[END_TITLE]\\n[AUTHOR]A[END_AUTHOR]\\n [TEXT]abstract[END_TEXT]' END || t AS page FROM p"""


def figure_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose figure blocks get coordinates; where a figure has no block the page fails and is null."""
    page = F.concat(F.lit("a\n[FIGURE:S1.F1]\n[FIGURE_TITLE]one[END_FIGURE_TITLE]\n[END_FIGURE]\n"), F.substring("text", 1, 30))
    figures = F.array(F.struct(F.when(F.col("doc_id") % 5 == 4, "2").otherwise("1").alias("n"), F.array(F.lit(59.5), F.lit(84.2), (F.lit(119.0) + F.col("doc_id") % 7), F.lit(168.4)).alias("box"), F.array(F.lit(59.5), F.when(F.col("doc_id") % 2 == 0, 190.0).otherwise(60.0), F.lit(119.0), F.lit(80.0)).alias("caption")))
    out = K.column(lambda p, f: M.with_coordinates(p, [tuple(x) for x in f]), "string", F.col("page"), F.col("figures"))
    return table(spark, sf_dir, "documents").select("doc_id", page.alias("page"), figures.alias("figures")).select("doc_id", out.alias("page"))


FIGURE_COORDINATES = r"""
WITH f AS (
  SELECT doc_id, substr(text, 1, 30) AS t, '[FIGURE_COORDS](x1=0.1, y1=0.8, x2=' || regexp_replace(format('{:.4f}', round((119 + doc_id % 7) / 595.0::DOUBLE, 4)), '(\.[0-9]+?)0+$', '\1') || ', y2=0.9)[END_FIGURE_COORDS]' AS c FROM documents
)
SELECT doc_id, CASE WHEN doc_id % 5 <> 4 THEN E'a\n[FIGURE:S1.F1]\n' || CASE WHEN doc_id % 2 = 0 THEN c || E'\n[FIGURE_TITLE]one[END_FIGURE_TITLE]' ELSE E'[FIGURE_TITLE]one[END_FIGURE_TITLE]\n' || c END || E'\n\n[END_FIGURE]\n' || t END AS page FROM f"""


# -- TeX --------------------------------------------------------------------------------------
_SOURCES = ["% c\n\\title{a {b {c}} d} x % y\n\n\n100\\% z\n", "\\maketitle\\author{A}\n  % only\nb\n", "\\date{{{{deep}}}} \\author{open\n", "a\\author{A {B}}%\n%\n"]


def tex_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TeX sources without comments and unused front matter."""
    return _docs(spark, sf_dir).select("doc_id", K.column(TX.prepared, "string", F.concat(_pick(_SOURCES), F.col("text"))).alias("tex"))


TEX_SOURCES = r"""
WITH s AS (
  SELECT doc_id, ([E'x \n100\\% z\n', E'\\maketitle\\author{A}\nb\n', E'\\date{{{{deep}}}} \\author{open\n', E'a\n'])[CAST(doc_id % 4 AS INT) + 1] AS head, string_split(text, E'\n') AS l FROM documents
), b AS (
  SELECT doc_id, head, list_transform(l, lambda x: regexp_extract(x, '^([^%\\]|\\.)*')) AS l FROM s
), c AS (
  SELECT doc_id, head || array_to_string(list_filter(l, lambda x, i: trim(x, E' \t\r') <> '' OR i = len(l)), E'\n') AS t FROM b
)
SELECT doc_id, regexp_replace(regexp_replace(t, '^\s+', ''), '\s+$', '') || E'\n' AS tex FROM c"""


def bibliographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of bibliography files made of benchmark passages: key, label and HTML entry."""
    entry = F.concat(F.lit("\\bibitem[{"), F.lit("A\\protect\\BIBand{}B \\emph{L}"), F.col("item_id").cast("string"), F.lit("}]{key"), F.col("item_id").cast("string"), F.lit("}\nA.~{\\sc Smith} and G{\\\"o}del, \\newblock {\\em On {B}races}, \\url{http://x.y/{z}} ``q''\\, "), F.substring("text", 1, 40), F.lit("\n"))
    items = table(spark, sf_dir, "benchmark").groupBy((F.col("item_id") % 5).alias("paper")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", entry.alias("e")))), lambda s: s["e"]), "").alias("b"))
    parsed = K.column(TX.bibliography_items, "array<struct<key:string,label:string,entry:string>>", F.concat(F.col("b"), F.lit("\\end{thebibliography}")))
    return items.select("paper", F.posexplode(parsed).alias("place", "i")).select("paper", "place", "i.*")


BIBLIOGRAPHIES = r"""
SELECT item_id % 5 AS paper, CAST(row_number() OVER (PARTITION BY item_id % 5 ORDER BY item_id) - 1 AS INT) AS place, 'key' || item_id AS key, 'A and B {L}' || item_id AS label,
  rtrim('A. SMITH and Gödel,  <em>On Braces</em>, http://x.y/z "q" ' || regexp_replace(substr(text, 1, 40), '\s+', ' ', 'g'), ' ') AS entry FROM benchmark"""


def fixed_bibliographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose empty bibliography section is made anew; pages without one are null, filled ones stay."""
    section = ['<section class="ltx_bibliography"><p>none</p></section>', '<section class="ltx_bibliography"><ul><li>one</li></ul></section>', ""]
    bbl = "\\bibitem{k1} One {\\em two}\\bibitem{k2} Three\\end{thebibliography}"
    page = F.concat(F.lit("<article>"), _pick(section, "page_id"), F.lit("</article>"))
    return table(spark, sf_dir, "pages").select("page_id", K.column(TX.fixed_bibliography, "string", page, F.lit(bbl)).alias("html"))


FIXED_BIBLIOGRAPHIES = """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN '<article><section class="ltx_bibliography" id="bib"><h2 class="ltx_title ltx_title_bibliography">References</h2><ul class="ltx_biblist"><li class="ltx_bibitem" id="bib.k1"><span class="ltx_tag ltx_role_refnum ltx_tag_bibitem"></span><span class="ltx_bibblock">One <em>two</em></span></li><li class="ltx_bibitem" id="bib.k2"><span class="ltx_tag ltx_role_refnum ltx_tag_bibitem"></span><span class="ltx_bibblock">Three</span></li></ul></section></article>'
  WHEN 1 THEN '<article><section class="ltx_bibliography"><ul><li>one</li></ul></section></article>' END AS html FROM pages"""


_MATH = ["see \\(\\alpha_{i}^2 + \\frac{a}{b}\\), \\[\\mathbf{x}\\in\\{1,2\\}\\] ", "$\\left(x\\right)$ and $$\\int_0^1 \\quad y$$ ", "\\(\\overset{a}{b} \\text{if } x\\leq y\\) ", "no math, $5 "]


def plain_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with their formulas as Unicode text."""
    return _docs(spark, sf_dir).select("doc_id", K.column(X.plain_formulas, "string", F.concat(_pick(_MATH), F.regexp_replace("text", r"\$", "S"))).alias("text"))


PLAIN_FORMULAS = r"""
SELECT doc_id, (['see αi2 + ab, x∈{1,2} ', '(x) and ∈t01   y ', 'b if  x≤ y ', 'no math, $5 '])[CAST(doc_id % 4 AS INT) + 1] || replace(text, '$', 'S') AS text FROM documents"""


_FORMULAS = ["$$ a \\le b % c\n\\displaystyle x $$", "\\( p \\land q\\)", "$ \\rightarrow z$", "\\[\\textstyle \\]", ""]


def normal_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas in one spelling, inline and display; the same with accents and symbols as commands; dollars as delimiters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _pick(_FORMULAS).alias("f"))
    inline, shown = (K.column(lambda f, i=i: X.normalize_tex(f, i), "string", F.col("f")) for i in (True, False))
    return docs.select("doc_id", inline.alias("inline"), shown.alias("display"), K.column(X.to_tex, "string", F.concat(F.lit("é→α€ ñ "), F.col("f"))).alias("commands"), K.column(TX.dollars, "string", F.concat(F.lit("a\\(x\\)b \\[y\\]\\[z\\] ****c_-"), F.col("f"))).alias("dollars"))


NORMAL_FORMULAS = r"""
WITH f AS (SELECT doc_id, doc_id % 5 AS k FROM documents)
SELECT doc_id, ([E'\\(a \\leq b   x\\)', '\(p \wedge q\)', '\(\to z\)', E'\\(\\)', ''])[CAST(k AS INT) + 1] AS inline, ([E'\\[a \\leq b   x\\]', '\[p \wedge q\]', '\[\to z\]', E'\\[\\]', ''])[CAST(k AS INT) + 1] AS display,
  rtrim('\''e\to \alpha  \~n ' || ([E'$$ a \\leq b % c\n\\displaystyle x $$', '\( p \wedge q\)', '$ \to z$', '\[\textstyle \]', ''])[CAST(k AS INT) + 1], ' ') AS commands,
  'a $ x $ b $ y $ $ z $ ** **c-_' || ([E'$$ a \\le b % c\n\\displaystyle x $$', '$ p \land q $', '$ \rightarrow z $', '$\textstyle $', ''])[CAST(k AS INT) + 1] AS dollars FROM f"""


# -- generated text ---------------------------------------------------------------------------
_ARTEFACTS = [
    "# 1. " + "a long heading that is text " * 5 + "\nx\n",
    "a\n* [leftmargin=*]\nb\n## 3\n\nText _x_ and _a__1_ .\nFootnote 1: thanks: me\n\n",
    "* [1][] A ref\n* [2] " + "A. " * 11 + "Many\n[FOOTNOTE:2]gone[END_FOOTNOTE]z\n",
    "p\n- one - 1.2 two - iv three\n\\begin{table} \\begin{tabular}{l l}  & \\\\ \\end{tabular} \\end{table} Table 1\n.\n\n\n\n",
    "(1) \\[a\\] \n(1.2a) \\[b\\]\nsee https://a.bc/d?e=1. and \\bm{x} ```code```\n",
    "q\n" + "## References\n" + "".join(f"* [{k}] Smith and others, a paper, 20{k:02d}.\n" for k in range(10, 30)),
]


def postprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated texts after all steps; artefacts of every step put in front."""
    return _docs(spark, sf_dir).select("doc_id", K.column(P.postprocessed, "string", F.concat(_pick(_ARTEFACTS), F.col("text"))).alias("text"))


def markdown_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portable markdown of every document with a form of each kind put in front."""
    put = "(1.2a) \\[b\\]\n\\[c\\] (3)\nsee https://a.bc/d?e=1, or ftp://h.org/x. \\bm{x}```code```\n"
    return _docs(spark, sf_dir).select("doc_id", K.column(P.markdown_compatible, "string", F.concat(F.lit(put), F.col("text"))).alias("text"))


MARKDOWN_COMPATIBLE = r"""
SELECT doc_id, E'\\[b \\tag{1.2a}\\]\n\\[c \\tag{3}\\]\nsee [https://a.bc/d?e=1](https://a.bc/d?e=1), or [ftp://h.org/x](ftp://h.org/x). \\mathbf{x}```\ncode\n```\n' || replace(text, '\. ', '. ') AS text FROM documents"""


def truncate_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without their repeating tails; every fourth one ends in a sentence said eight times."""
    text = F.when(F.col("doc_id") % 4 == 0, F.concat(F.col("text"), F.lit("\nA start. "), F.repeat(F.lit("This very sentence comes again and again.\n"), F.lit(8)))).otherwise(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", K.column(K.truncate_repetitions, "string", text).alias("text"))


def disclaimers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the note that an interface adds where output was cut or is missing."""
    repeats = F.when(F.col("turn") % 3 == 1, 0).when(F.col("turn") % 3 == 2, 7)
    rest = F.when(F.col("turn") % 4 == 1, " ").otherwise(F.concat(F.lit(" \\begin{table}"), F.col("role"), F.lit(" ")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.with_disclaimer(F.col("text"), repeats, rest).alias("page"))


DISCLAIMERS = r"""
SELECT conv_id, turn, text || CASE WHEN turn % 3 = 0 OR turn % 4 = 1 THEN '' ELSE CASE WHEN turn % 3 = 2 THEN E'\n\n+++ ==WARNING: Truncated because of repetitions==\n' ELSE E'\n\n+++ ==ERROR: No output for this page==\n' END
  || '\begin{table}' || role || ' \end{table}' || E'\n+++\n\n' END AS page FROM conversations"""

_SQL = "text_nodes figure_coordinates first_pages tex_sources bibliographies fixed_bibliographies plain_formulas normal_formulas markdown_compatible disclaimers".split()
QUERIES = {n: globals()[n] for n in [*_SQL, "html_to_markup", "markup_lines", "split_pages", "postprocessed", "truncate_repetitions"]}
ORACLES = {n: globals()[n.upper()] for n in _SQL}
