"""TeX sources and bibliographies: row-local kernels over brace groups."""

from __future__ import annotations

import html
import re
from collections.abc import Callable

# fixed values: braced accent commands and the characters they stand for
ACCENTED = {"{\\&}": "&amp;", "{\\'I}": "Í", '{\\"o}': "ö", '{\\"a}': "ä", "{\\'u}": "ú", "{\\'e}": "é", "{\\'a}": "á", "{\\'o}": "ó", "{\\'i}": "í", "{\\'E}": "É", "{\\'A}": "Á", "{\\'O}": "Ó", "{\\'U}": "Ú", "{\\'c}": "ç", "{\\'C}": "Ç", "{\\'n}": "ñ", "{\\'N}": "Ñ"}
# fixed values: spacing commands of one character
SPACING = "/!,;:. "
PLAIN_GROUP = re.compile(r"""\{([A-Za-z0-9_.,;:\-'"()!?+= /]+)\}""")


def group_end(text: str, at: int, depth: int | None = None) -> int:
    """Position behind the brace group that opens at ``at``; -1 if it never closes or nests deeper than ``depth``."""
    level = 0
    for k in range(at, len(text)):
        if text[k] == "{":
            level += 1
            if depth is not None and level > depth:
                return -1
        elif text[k] == "}":
            level -= 1
            if not level:
                return k + 1
    return -1


def without_comments(tex: str) -> str:
    """Lines that only comment go with the blank lines in front of them, trailing comments are cut, blank lines go."""
    kept: list[str] = []
    for line in tex.split("\n"):
        if line.lstrip().startswith("%"):
            while kept and not kept[-1].strip():
                kept.pop()
            continue
        at = line.find("%")
        while at > 0 and line[at - 1] == "\\":
            at = line.find("%", at + 1)
        kept.append(line if at < 0 else line[:at])
    inner = [x for k, x in enumerate(kept) if x.strip() or k in (0, len(kept) - 1)]
    return "\n".join(inner)


def without_front_matter(tex: str) -> str:
    """Author, title and date commands go where no title is made; their braces nest to depth three."""
    if "\\maketitle" in tex:
        return tex
    for name in ("\\author{", "\\title{", "\\date{"):
        at = 0
        while (at := tex.find(name, at)) >= 0:
            end = group_end(tex, at + len(name) - 1, depth=3)
            if end < 0:
                at += len(name)
            else:
                tex = tex[:at] + tex[end:]
    return tex


def prepared(tex: str | None) -> str | None:
    """A source without comments and unused front matter, stripped, with one newline at the end."""
    return None if tex is None else without_front_matter(without_comments(tex)).strip() + "\n"


def rewrapped(text: str, command: str, change: Callable[[str], str]) -> str:
    """Arguments of ``\\command{...}``, nested ones first, through ``change``; from an unclosed one on all stays."""
    opening = re.compile(r"\\" + command + r"\s*\{")
    out, at = [], 0
    while found := opening.search(text, at):
        end = group_end(text, found.end() - 1)
        if end < 0:
            break
        out += [text[at : found.start()], change(rewrapped(text[found.end() : end - 1], command, change))]
        at = end
    return "".join([*out, text[at:]])


def without_plain_groups(text: str) -> str:
    """Braces around plain text go, from the inside out."""
    while (bare := PLAIN_GROUP.sub(r"\1", text)) != text:
        text = bare
    return text


def accents(text: str) -> str:
    """Ties as blanks, doubled quotes as one, braced accents as characters."""
    text = text.replace("~", " ")
    for mark in ("`", "'"):
        text = re.sub(mark + "+", lambda m: '"' if len(m[0]) == 2 else m[0], text)
    for command, char in ACCENTED.items():
        text = text.replace(command, char)
    return text


def to_html(entry: str | None) -> str | None:
    """A bibliography entry as HTML text."""
    if entry is None:
        return None
    text = " ".join(entry.split())
    text = re.sub(r"\\[" + re.escape(SPACING) + "]", "", text)
    text = re.sub(r"\{\s*\\(sc|em|emph)\s+([^}]+)\}", lambda m: f"\\{m[1]}{{{m[2]}}}", text)
    text = re.sub(r"\\em\s*\{", r"\\emph{", text)
    text = " ".join(re.split(r"\\newblock\s*", text))
    text = rewrapped(text, "url", str)
    text = rewrapped(text, "emph", "<em>{}</em>".format)
    text = rewrapped(text, "sc", str.upper)
    return accents(without_plain_groups(text))


def bibliography_items(bbl: str | None) -> list[dict[str, str]] | None:
    """key, label and HTML entry of each item of a thebibliography file; a last item needs the environment's end."""
    if bbl is None:
        return None
    out = []
    pieces = bbl.split("\\bibitem")
    for k, piece in enumerate(pieces[1:], 1):
        if k == len(pieces) - 1:
            piece, closed, _ = piece.partition("\\end{thebibliography}")
            if not closed:
                break
        found = re.match(r"(?:\[\{(.*?)\}\])?\{(.*?)\}", piece, re.S)
        if found:
            label = re.sub(r"\\\w+", "", (found[1] or "").replace("\\protect\\BIBand", " and ").replace(" and {}", " and "))
            out.append({"key": found[2], "label": label.strip(), "entry": to_html(piece[found.end() :])})
    return out


def bibliography_section(bbl: str) -> str:
    items = "".join(f'<li class="ltx_bibitem" id="bib.{html.escape(i["key"])}"><span class="ltx_tag ltx_role_refnum ltx_tag_bibitem">{html.escape(i["label"], quote=False)}</span><span class="ltx_bibblock">{i["entry"]}</span></li>' for i in bibliography_items(bbl))
    return f'<section class="ltx_bibliography" id="bib"><h2 class="ltx_title ltx_title_bibliography">References</h2><ul class="ltx_biblist">{items}</ul></section>'


_SECTION = re.compile(r"<(/?)section\b([^>]*)>", re.I)


def fixed_bibliography(page: str | None, bbl: str | None) -> str | None:
    """The page with its bibliography section made anew from ``bbl``, unless it already lists items; null if it has none."""
    if page is None or bbl is None:
        return page
    marks = list(_SECTION.finditer(page))
    first = next((k for k, m in enumerate(marks) if not m[1] and re.search(r"""class\s*=\s*["'][^"']*\bltx_bibliography\b""", m[2])), None)
    if first is None:
        return None
    level, end = 0, len(page)
    for m in marks[first:]:
        level += -1 if m[1] else 1
        if not level:
            end = m.end()
            break
    start = marks[first].start()
    return page if re.search(r"<li\b", page[start:end], re.I) else page[:start] + bibliography_section(bbl) + page[end:]


# fixed values: math delimiters and joined marks, and what takes their place, in this order
DOLLARS = [("\\)\\(", "$ $"), ("\\(", "$"), ("\\)", "$"), ("\\]\\[", "$ $"), ("\\[", "$"), ("\\]", "$")]


def dollars(text: str | None) -> str | None:
    """Math delimiters of generated text as dollars, letters a blank apart from them; joined emphasis marks part."""
    if text is None:
        return None
    for old, new in DOLLARS:
        text = text.replace(old, new)
    text = re.sub(r"(?<=[a-zA-Z])(?=\$)", " ", text)
    text = re.sub(r"(?<=\$)(?=[a-zA-Z])", " ", text)
    return text.replace("****", "** **").replace("_-", "-_")


def dehyphenated(text: str | None) -> str | None:
    """Lines that end in a hyphen take the first word of the next line; line ends lose their blanks.

    Natural hyphens at a line end go too.  A line that gave its only word stays, empty.
    """
    if text is None:
        return None
    lines = [line.rstrip() for line in text.split("\n")]
    broken = [k for k, line in enumerate(lines[:-1]) if line.endswith("-")]
    for k in broken:
        word = lines[k + 1].partition(" ")[0]
        lines[k], lines[k + 1] = lines[k][:-1] + word, lines[k + 1][len(word) :]
    return "\n".join(lines)
