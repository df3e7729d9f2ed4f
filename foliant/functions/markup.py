"""Tagged markup of one document: its blocks, its lines, its float titles.  Row-local kernels."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

from .text import LINE_TAGS

FLOATS = ("FIGURE", "TABLE", "ALGORITHM")
_TEXT_TAGS = re.compile(r"\[(?:END_)?TEXT\]")
# fixed values: commands without meaning here
LAYOUT_COMMANDS = ("leavevmode", "nobreak", "pagebreak", "nopagebreak")
# fixed values: labels of a layout detector and the tags they stand for
VISUAL_TAGS = {"文章标题": "TITLE", "title": "TITLE", "作者": "AUTHOR", "author": "AUTHOR", "副标题": "ABSTRACT", "assistant_title": "ABSTRACT", "正文": "TEXT", "text": "TEXT", "子标题": "SECTION", "subtitle": "SECTION", "公式": "EQUATION", "formula": "EQUATION", "图片": "FIGURE", "figure": "FIGURE", "图片标题": "CAPTION", "figure_title": "CAPTION", "表格": "TABLE", "table": "TABLE", "表格标题": "CAPTION", "table_title": "CAPTION", "注释": "FOOTNOTE", "bottom_note": "FOOTNOTE", "算法": "ALGORITHM", "algorithm": "ALGORITHM", "参考文献": "BIBLIOGRAPHY", "reference": "BIBLIOGRAPHY"}


class Block(NamedTuple):
    start: int
    end: int
    name: str
    body: str


def blocks(doc: str, tag: str, named: bool = False) -> Iterator[Block]:
    """Blocks ``[TAG]…[END_TAG]``, or ``[TAG:name]…[END_TAG]`` if named, from left to right."""
    head, tail = f"[{tag}:" if named else f"[{tag}]", f"[END_{tag}]"
    at = 0
    while (a := doc.find(head, at)) >= 0:
        close = doc.find("]", a) if named else a + len(head) - 1
        b = doc.find(tail, close + 1) if close >= 0 else -1
        if b < 0:
            return
        at = b + len(tail)
        yield Block(a, at, doc[a + len(head) : close], doc[close + 1 : b])


def replaced(doc: str, found: list[Block], put: Callable[[Block], str]) -> str:
    out, at = [], 0
    for b in found:
        out += [doc[at : b.start], put(b)]
        at = b.end
    return "".join([*out, doc[at:]])


def one_line_authors(doc: str) -> str:
    """The first author block on one line, its footnotes behind it; all other author blocks repeat it."""
    found = list(blocks(doc, "AUTHOR"))
    if not found:
        return doc
    body = found[0].body
    notes = list(blocks(body, "FOOTNOTE", named=True))
    bare = replaced(body, notes, lambda b: "")
    line = "[AUTHOR]" + " ".join(s for s in map(str.strip, bare.split("\n")) if s) + "[END_AUTHOR]"
    if notes:
        line += "\n" + "\n".join(body[b.start : b.end] for b in notes) + "\n"
    return replaced(doc, found, lambda b: line)


def outer_text_only(doc: str) -> str:
    """Nested text blocks melt into the outermost.

    An outermost tag that never closes leaves the text in front of it twice.
    """
    out, depth, done, start = [], 0, 0, 0
    for m in _TEXT_TAGS.finditer(doc):
        if m[0] == "[TEXT]":
            if not depth:
                out.append(doc[done : m.start()])
                start = m.end()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                out.append("[TEXT]" + _TEXT_TAGS.sub("", doc[start : m.start()]) + "[END_TEXT]")
                done = m.end()
    return "".join([*out, doc[done:]])


def without_layout_commands(doc: str) -> str:
    doc = re.sub(r"\\(?:" + "|".join(LAYOUT_COMMANDS) + ")", "", doc)
    return re.sub(r"\\enlargethispage\{.*?\}", "", doc)


def copyright_first(doc: str) -> str:
    """The text block of a publisher's notice goes to the front."""
    for b in blocks(doc, "TEXT"):
        if "IEEE Copyright Notice" in b.body and "Personal use of this material is permitted" in b.body:
            return doc[b.start : b.end] + "\n" + doc[: b.start] + doc[b.end :]
    return doc


def _title(body: str, tags: tuple[str, ...]) -> str | None:
    """The first title block, tags included, that any of ``tags`` opens; any float's title tag may end it."""
    starts = [p for t in tags if (p := body.find(f"[{t}_TITLE]")) >= 0]
    if not starts:
        return None
    start = min(starts)
    ends = [p + len(f"[END_{t}_TITLE]") for t in tags if (p := body.find(f"[END_{t}_TITLE]", start)) >= 0]
    return body[start : min(ends)].strip() if ends else None


def without_ids(text: str) -> str:
    """Tags of capitals lose their ids."""
    return re.sub(r"\[([A-Z]+):[^\]]*\]", r"[\1]", text)


def float_objects(doc: str) -> dict[str, str]:
    """Title block to float: figures keep the lines of figure tags only, figures and tables lose ids."""
    doc = _TEXT_TAGS.sub("", re.sub("\n\n+", "\n", doc))
    out: dict[str, str] = {}
    for tag in FLOATS:
        for b in blocks(doc, tag, named=tag != "ALGORITHM"):
            title = _title(b.body, (tag,))
            if title is None:
                continue
            whole = doc[b.start : b.end]
            if tag != "ALGORITHM":
                whole = without_ids(whole)
            if tag == "FIGURE":
                whole = "\n".join(x for x in whole.split("\n") if x.startswith("[FIGURE"))
            out[title] = whole
    return out


def titles_for_floats(doc: str) -> str:
    """Floats give way to their titles, untitled ones to nothing; the first float end tag of any kind ends one."""
    out, at = [], 0
    opening = re.compile(r"\[(?:FIGURE:|TABLE:|ALGORITHM\])")
    closing = re.compile(r"\[END_(?:FIGURE|TABLE|ALGORITHM)\]")
    while m := opening.search(doc, at):
        close = doc.find("]", m.end() - 1)
        end = closing.search(doc, close + 1) if close >= 0 else None
        if end is None:
            break
        out += [doc[at : m.start()], _title(doc[close + 1 : end.start()], FLOATS) or ""]
        at = end.end()
    return "".join([*out, doc[at:]])


def tag_of(line: str) -> str:
    line = line.strip()
    return next((t for t in LINE_TAGS if line.startswith(f"[{t}") and line.endswith(f"[END_{t}]")), "TEXT")


class Lines(NamedTuple):
    lines: list[str]
    tags: list[str]
    objects: dict[str, str]


def parsed(doc: str) -> Lines:
    """Stripped, non-blank lines of a document with their tags, and its floats by title."""
    for step in (one_line_authors, outer_text_only, without_layout_commands, copyright_first):
        doc = step(doc)
    objects = float_objects(doc)
    bare = _TEXT_TAGS.sub("", titles_for_floats(doc))
    lines = [x for x in map(str.strip, bare.split("\n")) if x]
    return Lines(lines, [tag_of(x) for x in lines], objects)


def match_text(line: str, tag: str) -> str:
    """Lower-cased content of a line without its tag and heading marks; a line that does not have its tag's form stays whole."""
    if tag == "TEXT":
        return re.sub(r"\[[A-Z_]+\]", "", line).strip().lower()
    found = next(blocks(line, tag, named=tag == "FOOTNOTE"), None)
    if found is not None:
        line = found.body.strip()
        if tag in ("TITLE", "SUBTITLE") and line.startswith("#"):
            line = line.lstrip("#").lstrip()
    return line.strip().lower()


def wrapped(line: str) -> str:
    """Tagged lines lose their ids, all others become text lines."""
    tagged = re.match(r"\[[A-Z_]+(?::[^\]]*)?\]", line) and re.search(r"\[END_[A-Z_]+\]\Z", line)
    return without_ids(line) if tagged else f"[TEXT]{line}[END_TEXT]"


# -- first pages -------------------------------------------------------------------
def page_tags(page: str) -> list[str]:
    """Tags of lines that one tag opens and closes."""
    out = []
    for line in map(str.strip, page.split("\n")):
        m = re.match(r"\[([A-Z_]+)(?::[^\]]*)?\]", line)
        if m and line.endswith(f"[END_{m[1]}]") and len(line) >= m.end() + len(m[1]) + 6:
            out.append(m[1])
    return out


def retagged(page: str, tag: str, behind: str | None = None) -> str:
    """The first text line, if asked for the first one behind a line with ``behind``, gets ``tag``."""
    lines = page.split("\n")
    start = 0 if behind is None else next((k + 1 for k, x in enumerate(lines) if f"[{behind}]" in x), len(lines))
    for k in range(start, len(lines)):
        line = lines[k].strip()
        if line.startswith("[TEXT]") and line.endswith("[END_TEXT]"):
            lines[k] = f"[{tag}]{line[6:-10]}[END_{tag}]"
            break
    return "\n".join(lines)


def corrected_first_page(page: str | None, seen: list[str] | None, correctable: frozenset[str] = frozenset({"TITLE", "AUTHOR"})) -> str | None:
    """A first page whose missing title, author and abstract tags follow what the detector saw, in ``seen`` labels.

    The author comes behind a title, the abstract behind the author or else the
    title; without such a line no abstract is set.
    """
    if page is None or not seen:
        return page
    visual = {VISUAL_TAGS[x] for x in seen if x in VISUAL_TAGS}
    for tag in ("TITLE", "AUTHOR", "ABSTRACT"):
        have = page_tags(page)
        if tag not in correctable or tag not in visual or tag in have:
            continue
        anchors = {"TITLE": (), "AUTHOR": ("TITLE",), "ABSTRACT": ("AUTHOR", "TITLE")}[tag]
        anchor = next((a for a in anchors if a in have), None)
        if tag != "ABSTRACT" or anchor is not None:
            page = retagged(page, tag, anchor)
    return page


# -- figures --------------------------------------------------------------------------
def with_coordinates(page: str | None, figures: list | None, width: float = 595.0, height: float = 842.0) -> str | None:
    """A page whose figure blocks ``[FIGURE:….Fn]`` hold their coordinates.

    ``figures`` are (n, box, caption box) of the page's figures.  One that has no
    block, or an empty one, fails the page: the result is null.
    """
    if page is None:
        return None
    found = [b for b in blocks(page, "FIGURE", named=True) if ".F" in b.name]
    body = {b.name.partition(".F")[2]: b.body for b in found}
    for name, box, caption in figures or []:
        title = body.get(name, "").strip()
        if not title:
            return None
        x1, y1, x2, y2 = (round(v, 4) for v in (box[0] / width, 1 - box[3] / height, box[2] / width, 1 - box[1] / height))
        coords = f"[FIGURE_COORDS](x1={x1}, y1={y1}, x2={x2}, y2={y2})[END_FIGURE_COORDS]"
        below = caption[1] + caption[3] > box[1] + box[3]
        body[name] = body[name].replace(title, f"{coords}\n{title}\n" if below else f"{title}\n{coords}\n")
    return replaced(page, found, lambda b: f"[FIGURE:{b.name}]{body[b.name.partition('.F')[2]]}[END_FIGURE]")
