"""Article HTML as tagged markup, in one walk over a light element tree.

Every rule is a test on an element and a writer.  A writer renders the element
into a scope, whose parts become text when it closes, so no second tree of
document nodes is built.  What belongs elsewhere (list items, table cells,
captions, hoisted footnotes) goes to a slot of the scope that owns it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from .formulas import normalize_tex
from .text import DIGITS, ESCAPES, SUBSCRIPTS, SUPERSCRIPTS

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_OPAQUE = {"script", "style"}
# fixed values: classes whose elements vanish around their children, and classes that are not read
WRAPPERS = {"ltx_engrafo_equation_container", "ltx_note_content", "ltx_role_footnote", "ltx_note_type", "ltx_theorem", "ltx_proof", "ltx_quote", "ltx_inline-para", "ltx_inline-block"}
CAPTIONED = {"table": "TABLE_TITLE", "algorithm": "ALGORITHM_TITLE", "figure": "FIGURE_TITLE"}


@dataclass
class Element:
    tag: str
    attrs: dict[str, str]
    parent: Element | None = None
    children: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.classes = (self.attrs.get("class") or "").split()

    def has(self, *names: str) -> bool:
        return any(n in self.classes for n in names)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def below(self) -> Iterator[Element]:
        """All elements inside, in document order."""
        for c in self.children:
            if not isinstance(c, str):
                yield c
                yield from c.below()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if len(self.open) > 300:  # deeper nesting is flattened, so that no page exhausts the stack
            return
        e = Element(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(e)
        if tag not in _VOID:
            self.open.append(e)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag not in _OPAQUE:
            self.open[-1].children.append(data.replace("\u00a0", " "))


def parse(html: str) -> Element:
    """The element tree; stray end tags are ignored, open elements end with their parent."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


@dataclass
class Cell:
    text: str
    blank: bool
    align: str
    left: int
    right: int
    top: int
    bottom: int
    columns: int | None
    rows: int | None

    def spec(self) -> tuple:
        return self.left, self.right, self.align


@dataclass
class Scope:
    """What an open construct has gathered."""

    kind: str
    up: Scope | None = None
    escape: bool = False
    parts: list[str] = field(default_factory=list)
    slots: list = field(default_factory=list)
    late: list[str] = field(default_factory=list)
    caption: Scope | None = None
    header: Scope | None = None
    level: int = 1
    name: str | None = None

    def nearest(self, *kinds: str) -> Scope | None:
        at: Scope | None = self
        while at is not None and at.kind not in kinds:
            at = at.up
        return at

    def inner(self, kind: str, escape: bool | None = None) -> Scope:
        return Scope(kind, self, self.escape if escape is None else escape)

    def body(self) -> str:
        return "".join(self.parts)


def squeezed(text: str) -> str:
    """A text node: blanks as one, edge newlines as one; all-blank text loses its edge newlines."""
    if text.strip():
        head, tail = "\n" * text.startswith("\n"), "\n" * text.endswith("\n")
        text = head + text.strip("\n") + tail
    else:
        text = text.strip("\n")
    return re.sub(r"[ \t]+", " ", text)


def _edges(s: str) -> tuple[str, str, str]:
    return s[: len(s) - len(s.lstrip())], s.strip(), s[len(s.rstrip()) :]


class Writer:
    """Renders one article."""

    def __init__(self) -> None:
        self.title: str | None = None

    # -- walking ---------------------------------------------------------
    def children(self, e: Element, scope: Scope) -> Scope:
        for c in e.children:
            if isinstance(c, str):
                self.put_text(squeezed(c), scope)
            else:
                next(write for test, write in RULES if test(c))(self, c, scope)
        return scope

    def put_text(self, s: str, scope: Scope) -> None:
        scope.parts.append("".join(ESCAPES.get(c, c) for c in s) if scope.escape else s)

    def into(self, e: Element, scope: Scope, kind: str, escape: bool | None = None) -> Scope:
        return self.children(e, scope.inner(kind, escape))

    # -- inline ----------------------------------------------------------
    def inline(self, e: Element, scope: Scope) -> None:
        self.children(e, scope)

    def span(self, e: Element, scope: Scope) -> None:
        scope.parts.append(self.into(e, scope, "span").body())

    def plain_span(self, e: Element, scope: Scope) -> None:
        scope.parts.append(self.into(e, scope, "span", escape=False).body())

    def nothing(self, e: Element, scope: Scope) -> None:
        pass

    def tag_label(self, e: Element, scope: Scope) -> None:
        if e.has("ltx_tag_note"):
            if e.has("ltx_tag_bibitem"):
                self.span(e, scope)
        elif e.has("ltx_tag_section", "ltx_tag_subsection"):
            self.put_text(e.text().upper(), scope)
        else:
            self.children(e, scope)

    def styled(self, e: Element, scope: Scope) -> None:
        mark = "ITALIC" if e.has("ltx_font_italic") else "BOLD" if e.has("ltx_font_bold") else None
        body = self.into(e, scope, "span").body()
        if mark and scope.nearest("algorithm") is None:
            head, text, tail = _edges(body)
            body = f"{head}[{mark}_TEMP]{text.replace(chr(10), ' ')}[END_{mark}_TEMP]{tail}"
        scope.parts.append(body)

    def script(self, e: Element, scope: Scope) -> None:
        body = self.into(e, scope, "span", escape=False).body()
        if body.strip().isdigit():
            body = body.translate(str.maketrans(DIGITS, SUPERSCRIPTS if e.tag == "sup" else SUBSCRIPTS))
        scope.parts.append(body)

    def math(self, e: Element, scope: Scope) -> None:
        if e.tag == "math":
            tex, shown = e.attrs.get("alttext", ""), e.attrs.get("display", "inline") != "inline"
        else:
            held = next((x for x in e.below() if x.has("mjx-math")), None)
            if held is None:
                return
            tex, shown = held.attrs.get("aria-label", ""), e.has("ltx_DisplayMath")
        body = normalize_tex(rf"\[{tex}\]" if shown else rf"\({tex}\)", inline=not shown).strip()
        if scope.kind == "equation":
            scope.parts.append(normalize_tex(body, inline=False))
        else:
            scope.parts.append(f"\n\n{body}\n\n" if shown else body)

    def cite(self, e: Element, scope: Scope) -> None:
        body = self.into(e, scope, "span").body()
        bare = not ("[" in body and "]" in body) and not re.search("[A-Za-z]", body)
        scope.parts.append(f"[{body}]" if bare else body)

    def missing(self, e: Element, scope: Scope) -> None:
        shown, number = e.text().strip(), e.attrs.get("href", "").partition(".bib")[2]
        found = shown if shown.isnumeric() else number if number.isnumeric() else ""
        if found:
            self.put_text(found, scope)

    def reference(self, e: Element, scope: Scope) -> None:
        target, shown = e.attrs.get("href", ""), e.text()
        if not target.startswith("#bib"):
            return self.span(e, scope)
        if shown.strip().isnumeric():
            scope.parts.append(shown)
        elif re.search(r"[A-Za-z][:;.,_]?\d", shown):
            scope.parts.append("".join(c for c in target.partition(".bib")[2] if c.isdigit()))

    # -- blocks ----------------------------------------------------------
    def paragraph(self, e: Element, scope: Scope) -> None:
        inner = self.into(e, scope, "paragraph")
        scope.parts += [f"\n[TEXT]\n{inner.body()}\n[END_TEXT]\n", *inner.late]

    def footnote(self, e: Element, scope: Scope) -> None:
        around = scope.nearest("paragraph")
        home = around.up if around is not None and around.up is not None else scope
        inner = self.children(e, Scope("footnote", home))
        text = f"\n[FOOTNOTE:{inner.name}]{inner.name}{inner.body()}[END_FOOTNOTE]\n\n"
        (around.late if around is not None and around.up is not None else scope.parts).append(text)

    def note_mark(self, e: Element, scope: Scope) -> None:
        note = scope.nearest("footnote")
        if note is None:
            self.children(e, scope)
        else:
            note.name = "".join(piece.strip() for piece in _strings(e))

    def authors(self, e: Element, scope: Scope) -> None:
        scope.parts.append(f"[AUTHOR]\n{self.into(e, scope, 'authors', escape=False).body()}\n[END_AUTHOR]\n\n")

    def author(self, e: Element, scope: Scope) -> None:
        """An author element inside a creator is kept apart and not written."""
        self.into(e, scope, "author")

    def document_title(self, e: Element, scope: Scope) -> None:
        if self.title is None:
            self.title = f"[TITLE]# {self.into(e, scope, 'title').body().strip()}[END_TITLE]\n\n"

    def section(self, e: Element, scope: Scope) -> None:
        scope.parts.append(self._section(self.into(e, scope, "section", escape=False)))

    def _section(self, inner: Scope) -> str:
        body = inner.body()
        if not body.strip():
            return ""
        head = "" if inner.header is None else f"\n[SUBTITLE]{'#' * inner.level} {inner.header.body().strip()}[END_SUBTITLE]\n"
        return f"\n[TEXT]\n{head}{body}\n[END_TEXT]\n"

    def heading(self, e: Element, scope: Scope) -> None:
        if e.has("ltx_title_theorem", "ltx_title_proof"):
            self.children(e, scope)
            self.put_text(": ", scope)
        elif scope.kind == "section":
            scope.level = int(e.tag[1])
            scope.header = scope.header or scope.inner("span")
            self.children(e, scope.header)
        else:
            self.children(e, scope)

    def contents(self, e: Element, scope: Scope) -> None:
        inner = scope.inner("section", escape=False)
        inner.level, inner.header = 6, Scope("span", inner, parts=["Contents"])
        self.paragraph(e, inner)
        scope.parts.append(self._section(inner))

    def list_of(self, e: Element, scope: Scope) -> None:
        around = scope.nearest("list")
        inner = scope.inner("list", escape=False)
        inner.level = around.level + 1 if around else 1
        self.children(e, inner)
        bullet = "" if e.tag == "ol" else "*"
        lines = [f"{'  ' * (inner.level - 1)}{bullet} {item.strip().replace(chr(10), ' ')}\n" for item in inner.slots]
        scope.parts.append("\n" + "".join(lines) + "\n")

    def list_item(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("list")
        if home is not None:
            at = len(home.slots)
            home.slots.append("")
            inner = self.children(e, home.inner("item"))
            home.slots[at] = inner.body() + "".join(inner.late)

    def definitions(self, e: Element, scope: Scope) -> None:
        inner = self.into(e, scope, "definitions", escape=False)
        lines = []
        for term, meaning in inner.slots:
            head = "" if term is None else term.rstrip(" \n\t:") + ": "
            line = (head if head.strip() != ":" else "") + ("" if meaning is None else meaning.rstrip())
            lines += [line.rstrip() + "\n"] if line.strip() else []
        scope.parts.append("\n" + "".join(lines) + "\n" * bool(lines))

    def term(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("definitions")
        if home is not None:
            home.slots.append([self.children(e, home.inner("span")).body(), None])

    def meaning(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("definitions")
        if home is None:
            return self.inline(e, scope)
        if not home.slots or home.slots[-1][1] is not None:
            home.slots.append([None, None])
        home.slots[-1][1] = self.children(e, home.inner("span")).body()

    # -- formulas --------------------------------------------------------
    def equations(self, e: Element, scope: Scope) -> None:
        inner = self.into(e, scope, "equations", escape=False)
        lines = [s.rstrip() + "\n" for s in inner.slots if s.strip()]
        scope.parts.append("\n" + "".join(lines) + "\n" * bool(lines) + "\n\n")

    def equation(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("equations")
        if home is None:
            return self.inline(e, scope)
        parts = [p for p in self.children(e, home.inner("equation")).parts if p]
        while parts and not parts[0].strip():
            parts.pop(0)
        while parts and not parts[-1].strip():
            parts.pop()
        home.slots.append("[FORMULA]" + " ".join(parts).replace(r"\] \[", " ") + "[END_FORMULA]\n\n")

    # -- floats ----------------------------------------------------------
    def float_of(self, e: Element, scope: Scope, kind: str) -> Scope:
        inner = scope.inner(kind, escape=scope.escape if kind == "table" else False)
        inner.name = e.attrs.get("id")
        return self.children(e, inner)

    def caption_text(self, inner: Scope) -> str:
        return "" if inner.caption is None else f"\n[TEXT]\n{inner.caption.body()}\n[END_TEXT]\n"

    def table(self, e: Element, scope: Scope) -> None:
        inner = self.float_of(e, scope, "table")
        body, caption = inner.body(), self.caption_text(inner)
        name = f":{inner.name}" if inner.name is not None else hashlib.md5(body.encode("utf-8", "replace")).hexdigest()[:5]
        scope.parts.append(f"[TABLE{name}]\n\\begin{{table}}\n{body}\\end{{table}}\n" + (caption + "\n" if caption else "") + "[END_TABLE]\n\n")

    def figure(self, e: Element, scope: Scope) -> None:
        if any(x.has("ltx_listing") for x in e.below()):
            return self.algorithm(e, scope)
        inner = self.float_of(e, scope, "figure")
        head = f"\n[FIGURE:{inner.name}]\n" if inner.name else "[FIGURE]\n"
        scope.parts.append(f"{head}{self.caption_text(inner)}{inner.body()}[END_FIGURE]\n\n")

    def algorithm(self, e: Element, scope: Scope) -> None:
        inner = self.float_of(e, scope, "algorithm")
        lines = "".join(s.rstrip() + "\n" for s in inner.slots if s.strip())
        scope.parts.append(f"[ALGORITHM]\n{self.caption_text(inner)}" + (f"\n```\n{lines}```\n" if lines else "") + "[END_ALGORITHM]\n\n")

    def algorithm_float(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("algorithm")
        if home is None:
            self.algorithm(e, scope)
        else:
            self.children(e, home)

    def listing(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("algorithm")
        if home is None:
            return self.algorithm(Element("span", {}, e.parent, e.children), scope)
        for line in e.below():
            if line.has("ltx_listingline"):
                self.listing_line(line, home)

    def listing_line(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("algorithm")
        if home is not None:
            home.slots.append(self.children(e, home.inner("line")).body())

    def caption(self, e: Element, scope: Scope) -> None:
        home = scope.nearest(*CAPTIONED)
        if home is None:
            return self.paragraph(e, scope)
        home.caption = home.caption or Scope("paragraph", home)
        mark = CAPTIONED[home.kind]
        home.caption.parts.append(f"[{mark}]")
        self.children(e, home.caption)
        home.caption.parts.append(f"[END_{mark}]\n\n")

    def plain_caption(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("figure", "table")
        if home is None:
            return self.paragraph(e, scope)
        home.caption = home.caption or Scope("paragraph", home)
        self.children(e, home.caption)
        home.caption.parts.append("\n")

    # -- tables ----------------------------------------------------------
    def tabular(self, e: Element, scope: Scope) -> None:
        inner = self.into(e, scope, "tabular", escape=True)
        scope.parts.append(tabular_text(inner.slots))

    def head_rows(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("tabular")
        if home is not None:
            self.children(e, home)

    def row(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("tabular")
        if home is not None:
            inner = home.inner("row")
            home.slots.append(inner.slots)
            self.children(e, inner)

    def cell(self, e: Element, scope: Scope) -> None:
        home = scope.nearest("row")
        if home is None:
            return
        at = len(home.slots)
        home.slots.append(None)
        inner = self.children(e, home.inner("cell"))
        parts = list(inner.parts)
        while parts and not parts[-1].strip():
            parts.pop()
        borders = dict.fromkeys("tblr", 0)
        for c in e.classes:
            side = c.partition("border_")[2]
            if side[:1] in borders and side:
                borders[side[0]] = len(side)
        span = lambda name: int(e.attrs[name]) if e.attrs.get(name, "").isdigit() else None
        home.slots[at] = Cell("".join(parts), not e.children, alignment(e), borders["l"], borders["r"], borders["t"], borders["b"], span("colspan"), span("rowspan"))


def _strings(e: Element) -> Iterator[str]:
    for c in e.children:
        if isinstance(c, str):
            yield c
        else:
            yield from _strings(c)


def alignment(e: Element) -> str:
    """Column letter from the first class that speaks of alignment; justified cells get their width."""
    name = next((c for c in e.classes if "align" in c), None)
    if name is None:
        return ""
    if "justify" in name:
        style = e.attrs.get("style")
        return "c" if style is None else "p{" + style.partition("width:")[2].partition(";")[0] + "}"
    return next((side[0] for side in ("center", "left", "right") if side in name), "c")


def rules_of(borders: list[int], width: int) -> str:
    """Horizontal rules from the border weights of a row's columns: whole rows as hline, runs as cline."""
    out, start = [], None
    for i, weight in enumerate([*borders, 0]):
        if weight and start is None:
            start = i
        elif not weight and start is not None:
            out.append("\\hline " * borders[0] if i - start == width else f"\\cline{{{start + 1}-{i}}} ")
            start = None
    return "".join(out).strip()


def cell_places(row: list[Cell]) -> list[int]:
    """Columns that end with each cell, cumulated."""
    total, out = 0, []
    for c in row:
        total += c.columns or 1
        out.append(total)
    return out


def tabular_text(rows: list[list[Cell]]) -> str:
    """A TeX tabular: spanned places are filled, each column takes its commonest style, cells of another style say so."""
    for i, row in enumerate(rows):
        for j, c in enumerate(list(row)):
            if c.rows is not None and c.rows > 1:
                filler = Cell("", True, c.align, c.left, c.right, 0, c.bottom, None, None)
                c.bottom = 0
                for lower in rows[i + 1 : i + c.rows]:
                    lower[j:j] = [Cell(**vars(filler)) for _ in range(c.columns or 1)]
    width = max((cell_places(r)[-1] for r in rows if r), default=0)
    styles: list[tuple] = []
    for j in range(width):
        seen: dict[tuple, int] = {}
        for r in rows:
            c = r[j] if j < len(r) else None
            if c is not None and c.align and c.columns is None and c.rows is None:
                seen[c.spec()] = seen.get(c.spec(), 0) + 1
        styles.append(max(seen, key=seen.get) if seen else (0, 0, ""))
    shown = lambda spec: "|" * spec[0] + (spec[2] or "c") + "|" * spec[1]
    lines = []
    for r in rows:
        cells = []
        for j, c in enumerate(r):
            style = styles[j] if j < width else (0, 0, "")
            if c.spec() != style and c.columns is None and not (c.blank and c.spec()[:2] == style[:2]):
                c.columns = 1
            text = c.text if c.rows is None else f"\\multirow{{{c.rows}}}{{*}}{{{c.text}}}"
            cells.append((text if c.columns is None else f"\\multicolumn{{{c.columns}}}{{{shown(c.spec())}}}{{{text}}}").replace("\n", " "))
        n = sum(c.columns or 1 for c in r)
        above, below = (rules_of([w for c in r for w in [getattr(c, side)] * (c.columns or 1)], n) for side in ("top", "bottom"))
        lines.append((above + "\n" if above else "") + " & ".join(cells) + " \\\\" + (" " + below).rstrip())
    spec = re.sub(r"(?<=\|) +(?=\w)|(?<=\w) +(?=\|)", "", " ".join(map(shown, styles)))
    return f"\\begin{{tabular}}{{{spec}}}\n" + "\n".join(lines) + "\n\\end{tabular}\n"


Test = Callable[[Element], bool]


def _tag(*names: str) -> Test:
    return lambda e: e.tag in names


def _class(*names: str) -> Test:
    return lambda e: e.has(*names)


def _both(tags: tuple, names: tuple) -> Test:
    return lambda e: e.tag in tags and e.has(*names)


def _inside(e: Element, name: str) -> bool:
    at = e.parent
    while at is not None:
        if at.has(name):
            return True
        at = at.parent
    return False


_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: The first test that holds names the writer.
RULES: list[tuple[Test, Callable]] = [
    (lambda e: e.tag == "p" or e.has("ltx_p") or e.tag in ("div", "span") and e.has("ltx_para") or e.tag == "section" and e.has("ltx_paragraph"), Writer.paragraph),
    (_class("ltx_tag"), Writer.tag_label),
    (_class("ltx_note_outer"), Writer.footnote),
    (lambda e: e.has("ltx_note_mark") and e.parent is not None and e.parent.has("ltx_note_content"), Writer.note_mark),
    (_tag("sup", "sub"), Writer.script),
    (_both(("span",), ("ltx_Math", "ltx_DisplayMath")), Writer.math),
    (_both(("math",), ("ltx_Math",)), Writer.math),
    (_both(("a",), ("ref",)), Writer.span),
    (lambda e: e.has("ltx_ref") and e.has("ltx_missing_citation", "ltx_missing_label"), Writer.missing),
    (_class("ltx_bibblock", "ltx_contact", "ltx_role_email", "ltx_role_affiliation"), Writer.span),
    (_class("ltx_authors"), Writer.authors),
    (lambda e: e.has("ltx_role_author") and _inside(e, "ltx_creator"), Writer.author),
    (_class("ltx_author_notes", "ltx_acknowledgements"), Writer.plain_span),
    (lambda e: e.has("ltx_personname", "ltx_engrafo_author_notes") or e.has("ltx_role_creation") and e.has("ltx_date"), Writer.span),
    (_class("ltx_author_before", "ltx_role_pubyear", "ltx_role_pagerange"), Writer.span),
    (_both(("h1",), ("ltx_title_document",)), Writer.document_title),
    (_tag("section"), Writer.section),
    (_both(_HEADINGS, ("ltx_title",)), Writer.heading),
    (lambda e: e.has("ltx_TOC") and e.has("ltx_toc_toc"), Writer.contents),
    (lambda e: e.tag == "ul" and e.has("ltx_itemize", "ltx_toclist", "ltx_biblist") or e.tag == "ol" and e.has("ltx_enumerate"), Writer.list_of),
    (_both(("li",), ("ltx_item", "ltx_tocentry", "ltx_bibitem")), Writer.list_item),
    (_tag("cite"), Writer.cite),
    (_both(("a",), ("ltx_ref",)), Writer.reference),
    (lambda e: e.tag == "a" and not e.classes, Writer.span),
    (_class("ltx_eqn_table"), Writer.equations),
    (_class("ltx_eqn_row"), Writer.equation),
    (_class("ltx_eqn_cell"), Writer.inline),
    (lambda e: e.tag == "table" or e.tag in ("span", "div") and e.has("ltx_tabular"), Writer.tabular),
    (_both(("thead",), ("ltx_thead",)), Writer.head_rows),
    (_both(("tbody",), ("ltx_tbody",)), Writer.inline),
    (_both(("tr",), ("ltx_tr",)), Writer.row),
    (lambda e: e.tag == "td" and e.has("ltx_td") or e.tag == "th" and e.has("ltx_th"), Writer.cell),
    (lambda e: e.tag == "span" and e.has("ltx_text") or e.tag == "em" and e.has("ltx_emph"), Writer.styled),
    (_both(("figure",), ("ltx_table",)), Writer.table),
    (_both(("figure", "span"), ("ltx_figure",)), Writer.figure),
    (_class("ltx_float_algorithm"), Writer.algorithm_float),
    (_both(("figure",), ("ltx_float",)), Writer.inline),
    (_class("ltx_float_caption", "ltx_caption"), Writer.caption),
    (_class("ltx_listing"), Writer.listing),
    (_class("ltx_listingline"), Writer.listing_line),
    (_both(("dl",), ("ltx_description",)), Writer.definitions),
    (_both(("dt",), ("ltx_item",)), Writer.term),
    (_both(("dd",), ("ltx_item",)), Writer.meaning),
    (_tag("figcaption"), Writer.plain_caption),
    (_class("ltx_abstract"), Writer.section),
    (_class("ltx_ERROR"), Writer.nothing),
    (lambda e: e.tag in ("tbody", "blockquote") or e.has(*WRAPPERS), Writer.inline),
    (lambda e: e.has("ltx_rule") or e.has("ltx_pagination") and e.has("ltx_role_newpage"), Writer.nothing),
    (lambda e: True, Writer.span),
]


def tidied(text: str) -> str:
    """Markup without blanks at line ends and in runs, with at most one blank line, and title tags close to their text."""
    lines = text.replace("\u00a0", " ").split("\n")
    for k, line in enumerate(lines):
        line = line[:-1] if line.endswith(" ") else line
        if not line.strip(" \t"):
            line = ""
        # blanks that open a line are its indent: the first stays apart from the run behind it
        lead = 1 if k and line[:1] == " " else 0
        lines[k] = line[:lead] + re.sub(" {2,}", " ", line[lead:])
    text = re.sub("\n{3,}", "\n\n", "\n".join(lines)).lstrip()
    for mark in ("TABLE_TITLE", "FIGURE_TITLE", "ALGORITHM_TITLE"):
        open_, close = f"[{mark}]", f"[END_{mark}]"
        head, *rest = text.split(open_)
        text = open_.join([head, *(r.lstrip() for r in rest)])
        *front, last = text.split(close)
        pieces = [p.rstrip() if k < len(front) else p for k, p in enumerate([*front, last])]
        text = pieces[0] + "".join(f"{close}\n{p.lstrip(chr(10))}" for p in pieces[1:])
    return text


def to_markup(html: str | None) -> str | None:
    """Tagged markup of a page's first article; a page without one gives an empty text, a null page null."""
    if html is None:
        return None
    article = next((e for e in parse(html).below() if e.tag == "article"), None)
    if article is None:
        return ""
    writer = Writer()
    body = writer.children(article, Scope("document"))
    title = "" if writer.title is None else writer.title + "\n"
    return tidied(title + "\n" + body.body() + "".join(body.late))


def bibliography(html: str | None) -> list[str] | None:
    """Texts of the article's bibliography items, pieces stripped and joined."""
    if html is None:
        return None
    article = next((e for e in parse(html).below() if e.tag == "article"), None)
    return [] if article is None else ["".join(s.strip() for s in _strings(e)) for e in article.below() if e.tag == "li" and e.has("ltx_bibitem")]


def floats(markup: str | None) -> dict[str, str] | None:
    """Footnotes, figures and tables of a markup text by kind and id, ids folded to ASCII."""
    if markup is None:
        return None
    out: dict[str, str] = {}
    at = 0
    opening = re.compile(r"\[(FOOTNOTE|FIGURE|TABLE)([^\]]*)\]")
    while found := opening.search(markup, at):
        end = markup.find(f"[END_{found[1]}]", found.end())
        at = found.end() if end < 0 else end
        if end >= 0:
            name = unicodedata.normalize("NFKD", found[1] + found[2]).encode("ascii", "ignore").decode()
            out[name] = markup[found.end() : end].strip()
    return out
