"""HTML to markup node by node, the line model, and the split into pages."""

from __future__ import annotations

import random

import pytest

from foliant.functions import html as H
from foliant.functions import markup as M
from foliant.operators import paging as G


def of(inner: str) -> str:
    return H.to_markup(f"<article>{inner}</article>")


CASES = {
    "unknown elements keep their children": ("<h1>T&amp;x</h1><b>one</b> two<br>three", "T&xone twothree"),
    "paragraphs": ("<p>a</p><div class='ltx_para'>b</div>", "[TEXT]\na\n[END_TEXT]\n\n[TEXT]\nb\n[END_TEXT]\n"),
    "tags": ("<span class='ltx_tag'>1</span><span class='ltx_tag ltx_tag_section'>a</span><span class='ltx_tag ltx_tag_note'>n</span>", "1A"),
    "footnotes leave their paragraph": ("<p>a<span class='ltx_note_outer'><span class='ltx_note_content'><sup class='ltx_note_mark'>2</sup>n</span></span>b</p>", "[TEXT]\nab\n[END_TEXT]\n\n[FOOTNOTE:2]2n[END_FOOTNOTE]\n\n"),
    "scripts": ("x<sup>12</sup><sub>3</sub><sup>th</sup>", "x¹²₃th"),
    "inline math": ("<math class='ltx_Math' alttext='a\\le b'></math>", "\\(a\\leq b\\)"),
    "display math": ("x<math class='ltx_Math' alttext='a' display='block'></math>y", "x\n\n\\[a\\]\n\ny"),
    "rendered math": ("<span class='ltx_Math'><span class='mjx-math' aria-label='z'></span></span>", "\\(z\\)"),
    "missing references": ("<span class='ltx_ref ltx_missing_citation'>4</span><a class='ltx_ref ltx_missing_label' href='#x.bib9'>?</a><span class='ltx_ref ltx_missing_label'>?</span>", "49"),
    "citations": ("<cite>1, 2</cite><cite>[3]</cite><cite>A 4</cite>", "[1, 2][3]A 4"),
    "references": ("<a class='ltx_ref' href='#bib.bib7'>12</a><a class='ltx_ref' href='#bib.bib7'>Sm2</a><a class='ltx_ref' href='#bib.bib7'>Smith</a><a class='ltx_ref' href='#S1'>here</a><a href='x'>link</a>", "127herelink"),
    "authors": ("<div class='ltx_authors'><span class='ltx_personname'>A</span></div>", "[AUTHOR]\nA\n[END_AUTHOR]\n\n"),
    "the first document title": ("<h1 class='ltx_title ltx_title_document'> T </h1><h1 class='ltx_title ltx_title_document'>U</h1>x", "[TITLE]# T[END_TITLE]\n\nx"),
    "sections": ("<section><h3 class='ltx_title'>H</h3><p>b</p></section><section><h3 class='ltx_title'>empty</h3></section>", "[TEXT]\n\n[SUBTITLE]### H[END_SUBTITLE]\n\n[TEXT]\nb\n[END_TEXT]\n\n[END_TEXT]\n"),
    "theorem titles": ("<h6 class='ltx_title ltx_title_theorem'>Lemma</h6>", "Lemma:"),
    "lists": ("<ul class='ltx_itemize'>lost<li class='ltx_item'>a<ul class='ltx_itemize'><li class='ltx_item'>b</li></ul></li></ul><ol class='ltx_enumerate'><li class='ltx_item'>c</li></ol><li class='ltx_item'>lost</li>", "* a * b\n\n c\n\n"),
    "equations": ("<table class='ltx_eqn_table'><tr class='ltx_eqn_row'><td class='ltx_eqn_cell'><math class='ltx_Math' alttext='a' display='block'></math></td><td class='ltx_eqn_cell'><math class='ltx_Math' alttext='b'></math></td></tr></table>", "[FORMULA]\\[a b\\][END_FORMULA]\n\n"),
    "emphasis": ("<span class='ltx_text ltx_font_bold'> b\nc </span><em class='ltx_emph ltx_font_italic'>i</em><span class='ltx_text'>p</span>", "[BOLD_TEMP]b c[END_BOLD_TEMP] [ITALIC_TEMP]i[END_ITALIC_TEMP]p"),
    "figures": ("<figure class='ltx_figure' id='F1'>img<figcaption class='ltx_caption'>cap</figcaption></figure>", "[FIGURE:F1]\n\n[TEXT]\n[FIGURE_TITLE]cap[END_FIGURE_TITLE]\n[END_TEXT]\nimg[END_FIGURE]\n\n"),
    "algorithms": ("<figure class='ltx_float_algorithm'><figcaption class='ltx_caption'>cap</figcaption><div class='ltx_listing'><div class='ltx_listingline'>l1 </div><div class='ltx_listingline'> </div><div class='ltx_listingline'>l2</div></div></figure>", "[ALGORITHM]\n\n[TEXT]\n[ALGORITHM_TITLE]cap[END_ALGORITHM_TITLE]\n[END_TEXT]\n\n```\nl1\nl2\n```\n[END_ALGORITHM]\n\n"),
    "definitions": ("<dl class='ltx_description'><dt class='ltx_item'>t:</dt><dd class='ltx_item'>d</dd><dd class='ltx_item'>e</dd></dl>", "t: d\ne\n\n"),
    "dropped elements": ("a<span class='ltx_ERROR'>err</span><span class='ltx_rule'>r</span><blockquote>q</blockquote>", "aq"),
    "scripts are not read": ("a<script>var t='</p>';</script><style>x</style>b", "ab"),
}


@pytest.mark.parametrize("name", CASES)
def test_nodes(name):
    inner, expected = CASES[name]
    assert of(inner) == expected


def test_tables():
    cell = lambda text, classes, more="": f"<td class='ltx_td {classes}' {more}>{text}</td>"
    row = lambda *cells: f"<tr class='ltx_tr'>{''.join(cells)}</tr>"
    rows = [
        row(cell("a&amp;b", "ltx_align_left ltx_border_t"), cell("c", "ltx_align_right ltx_border_t", "colspan='2'")),
        row(cell("r", "ltx_align_left", "rowspan='2'"), cell("d", "ltx_align_center ltx_border_b"), cell("e\nf", "ltx_align_center")),
        row(cell("g", "ltx_align_center"), cell("h", "ltx_align_left")),
    ]
    got = of(f"<table class='ltx_tabular'><tbody class='ltx_tbody'>{''.join(rows)}</tbody></table>")
    assert got == (
        "\\begin{tabular}{l c c}\n\\hline\na\\&b & \\multicolumn{2}{r}{c} \\\\\n\\multirow{2}{*}{r} & d & e f \\\\ \\cline{2-2}\n & g & \\multicolumn{1}{l}{h} \\\\\n\\end{tabular}\n"
    )
    assert H.rules_of([1, 1, 0, 2], 4) == "\\cline{1-2} \\cline{4-4}"
    assert H.rules_of([2, 2], 2) == "\\hline \\hline"
    assert H.tabular_text([]) == "\\begin{tabular}{}\n\n\\end{tabular}\n"


def test_articles():
    assert H.to_markup(None) is None
    assert H.to_markup("<p>no article</p>") == ""
    assert H.to_markup("") == ""
    assert len(H.to_markup("<article>" + "<div>" * 5000 + "x")) == 1  # no depth exhausts the stack
    assert H.bibliography("<article><li class='ltx_bibitem'><b> A </b>\n x </li></article>") == ["Ax"]
    assert H.floats("[FIGURE:é1]a[END_FIGURE][TABLEab] t [END_TABLE][FOOTNOTE:1]open") == {"FIGURE:e1": "a", "TABLEab": "t"}


def test_tidied():
    assert H.tidied("  a  b \n   c\n \t\n\n\nd\u00a0e") == "a b\n  c\n\nd e"
    assert H.tidied("x [TABLE_TITLE] \n t \n[END_TABLE_TITLE]\n\n\ny") == "x [TABLE_TITLE]t[END_TABLE_TITLE]\ny"


# -- blocks and lines -------------------------------------------------------------------------
def test_blocks():
    assert M.one_line_authors("[AUTHOR]\nA\n[FOOTNOTE:1]n[END_FOOTNOTE]\n B\\1\n[END_AUTHOR]x[AUTHOR]C[END_AUTHOR]") == "[AUTHOR]A B\\1[END_AUTHOR]\n[FOOTNOTE:1]n[END_FOOTNOTE]\nx[AUTHOR]A B\\1[END_AUTHOR]\n[FOOTNOTE:1]n[END_FOOTNOTE]\n"
    assert M.outer_text_only("a[TEXT]b[TEXT]c[END_TEXT]d[END_TEXT]e") == "a[TEXT]bcd[END_TEXT]e"
    assert M.outer_text_only("a[TEXT]b") == "aa[TEXT]b"
    assert M.without_layout_commands("\\leavevmode\\nobreak\\enlargethispage{2pt}x\\nopagebreak") == "x"
    notice = "[TEXT]IEEE Copyright Notice: Personal use of this material is permitted[END_TEXT]"
    assert M.copyright_first(f"[TEXT]a[END_TEXT]{notice}b") == f"{notice}\n[TEXT]a[END_TEXT]b"


def test_floats_and_titles():
    figure = "[FIGURE:S1.F1]\nimg\n[FIGURE_TITLE]one[END_FIGURE_TITLE]\n[END_FIGURE]"
    table = "[TABLE:T1]\n\\begin{table}\n[TABLE_TITLE]two[END_TABLE_TITLE]\n[END_TABLE]"
    objects = M.float_objects(figure + "\n\n" + table)
    assert objects == {"[FIGURE_TITLE]one[END_FIGURE_TITLE]": "[FIGURE]\n[FIGURE_TITLE]one[END_FIGURE_TITLE]", "[TABLE_TITLE]two[END_TABLE_TITLE]": "[TABLE]\n\\begin{table}\n[TABLE_TITLE]two[END_TABLE_TITLE]\n[END_TABLE]"}
    assert M.titles_for_floats(f"a {figure} b {table} c [FIGURE:x]no title[END_FIGURE] d") == "a [FIGURE_TITLE]one[END_FIGURE_TITLE] b [TABLE_TITLE]two[END_TABLE_TITLE] c  d"


def test_lines():
    got = M.parsed("[TEXT]\na\n[END_TEXT]\n[SUBTITLE]## S[END_SUBTITLE]\n[FOOTNOTE:1]n[END_FOOTNOTE]")
    assert got.lines == ["a", "[SUBTITLE]## S[END_SUBTITLE]", "[FOOTNOTE:1]n[END_FOOTNOTE]"]
    assert got.tags == ["TEXT", "SUBTITLE", "FOOTNOTE"]
    assert [M.match_text(x, t) for x, t in zip(got.lines, got.tags, strict=True)] == ["a", "s", "n"]
    assert M.match_text("[TITLE:3]Ab[END_TITLE]", "TITLE") == "[title:3]ab[end_title]"
    assert M.match_text("[FOOTNOTE]n[END_FOOTNOTE]", "FOOTNOTE") == "[footnote]n[end_footnote]"
    assert M.wrapped("[FIGURE:F1]x[TABLE:T]y[END_FIGURE]") == "[FIGURE]x[TABLE]y[END_FIGURE]"
    assert M.wrapped("x [TITLE]y[END_TITLE]") == "[TEXT]x [TITLE]y[END_TITLE][END_TEXT]"


def test_first_pages():
    page = "[TEXT]T[END_TEXT]\n[TEXT]A[END_TEXT]\n[TEXT]X[END_TEXT]"
    every = frozenset({"TITLE", "AUTHOR", "ABSTRACT"})
    assert M.corrected_first_page(page, ["author", "title", "副标题"], every) == "[TITLE]T[END_TITLE]\n[AUTHOR]A[END_AUTHOR]\n[ABSTRACT]X[END_ABSTRACT]"
    assert M.corrected_first_page(page, ["副标题"], every) == page
    assert M.corrected_first_page(page, ["author"]) == page.replace("[TEXT]T[END_TEXT]", "[AUTHOR]T[END_AUTHOR]")
    assert M.corrected_first_page(page, []) == page
    assert M.corrected_first_page(None, ["title"]) is None


def test_coordinates():
    page = "a[FIGURE:S1.F1]\ncap\n[END_FIGURE]b"
    below = M.with_coordinates(page, [("1", (59.5, 84.2, 119.0, 168.4), (0, 170, 0, 180))])
    assert below == "a[FIGURE:S1.F1]\n[FIGURE_COORDS](x1=0.1, y1=0.8, x2=0.2, y2=0.9)[END_FIGURE_COORDS]\ncap\n\n[END_FIGURE]b"
    assert "cap\n[FIGURE_COORDS]" in M.with_coordinates(page, [("1", (59.5, 84.2, 119.0, 168.4), (0, 10, 0, 20))])
    assert M.with_coordinates(page, [("2", (0, 0, 1, 1), (0, 0, 1, 1))]) is None
    assert M.with_coordinates(page, []) == page


# -- pages ------------------------------------------------------------------------------------------
def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_pages_of_a_clean_document():
    rng = random.Random(1)
    lines = [sentence(rng, 6) for _ in range(9)]
    pages = [[lines[0], lines[1], "1"], [lines[2], lines[4], "2"], [lines[6], lines[8]]]
    got = G.split_markup("\n".join(f"[TEXT]\n{x}\n[END_TEXT]" for x in lines), pages)
    assert [p["valid"] for p in got] == [True, True, True]
    text = lambda *ks: "\n".join(f"[TEXT]{lines[k]}[END_TEXT]" for k in ks)
    # a gap at the first line of a page belongs to the page before
    assert [p["text"] for p in got] == [text(0, 1), text(2, 3, 4, 5), text(6, 7, 8)]


def test_a_line_on_two_pages_is_cut():
    rng = random.Random(4)
    first, second = sentence(rng, 8), sentence(rng, 8)
    doc = f"[TEXT]\n{first} {second}\n[END_TEXT]"
    got = G.split_markup(doc, [[first], [second]])
    assert [p["text"] for p in got] == [f"[TEXT]{first}[END_TEXT]", f"[TEXT]{second}[END_TEXT]"]


def test_floats_come_back_and_are_used_once():
    rng = random.Random(6)
    a, b, cap = sentence(rng, 6), sentence(rng, 6), sentence(rng, 5)
    doc = f"[TEXT]\n{a}\n[END_TEXT]\n[FIGURE:S1.F1]\n\n[TEXT]\n[FIGURE_TITLE]{cap}[END_FIGURE_TITLE]\n[END_TEXT]\n[END_FIGURE]\n[TEXT]\n{b}\n[END_TEXT]"
    got = G.split_markup(doc, [[a, cap], [cap, b]])
    assert got[0]["text"] == f"[TEXT]{a}[END_TEXT]\n[FIGURE]\n[FIGURE_TITLE]{cap}[END_FIGURE_TITLE]"
    assert got[1]["text"] == f"[TEXT]{b}[END_TEXT]"
    assert G.split_markup(None, [[]]) is None
    assert G.split_markup("", [["x"], []]) == [{"text": "", "valid": True}, {"text": "", "valid": True}]


def test_a_gap_behind_noise_spoils_both_pages():
    rng = random.Random(8)
    lines = [sentence(rng, 6) for _ in range(4)]
    got = G.split_markup("\n".join(lines), [[lines[0]], ["7", lines[3]]])
    assert [p["valid"] for p in got] == [False, False]


def test_ordered_lines_never_go_back():
    rng = random.Random(12)
    for _ in range(200):
        n = rng.randint(1, 12)
        ordered = [rng.random() < 0.8 for _ in range(n)]
        pages = [[G.Match(k, "", rng.choice([None, *range(n)])) for k in range(rng.randint(0, 6))] for _ in range(rng.randint(1, 5))]
        pages = [[m if m.number is None else m._replace(ordered=ordered[m.number]) for m in p] for p in pages]
        got = G.assign(pages, ordered)
        assert len(got) == len(pages)
        flow = [x for p in got for x in p.numbers if ordered[x]]
        assert flow == sorted(flow)
        per_page = [{x for x in p.numbers if not ordered[x]} for p in got]
        assert sum(map(len, per_page)) == len(set().union(*per_page)), "an unordered line stands on one page only"


def test_grams():
    assert G.grams(["a", "b", "c", "d", "e"], index=False) == ["a b c d", "b c d e"]
    assert G.grams(["a", "b"], index=True) == ["a b"]
    assert G.grams(["ab", "c"], index=True) == ["ab", "ab c"]
    assert len(G.grams([f"w{k}" for k in range(9)], index=True)) == 7 + 8
    assert len(G.grams([f"w{k}" for k in range(11)], index=False)) == 9
    assert G.grams([], index=True) == []


def test_gates():
    assert G.digit_line("<12>") and G.digit_line("（1_2）") and not G.digit_line("[1a]") and not G.digit_line("-")
    assert G.without_abstract("abstract.—" + "x" * 30) == "x" * 30
    assert G.length_penalty("ab", "x" * 100) == pytest.approx(2 / 3)
    assert G.merged_gap("one two three", 2, 8, "ne", "three") == (7, 8)
