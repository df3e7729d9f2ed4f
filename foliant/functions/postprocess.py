"""Post-processing of generated markup: repeats, hallucinated references, artefacts, spacing.  Row-local kernels."""

from __future__ import annotations

import re
from collections.abc import Callable, Set
from itertools import groupby

from .kernels import truncate_repetitions

MISSING = "\n\n[MISSING_PAGE_POST]\n\n"
#: Two lines are alike above this share of common characters.
ALIKE = 0.9
_NUMERALS = frozenset("0123456789ixv")


def ratio(a: str, b: str) -> float:
    """Share of characters in a longest common subsequence: 2 LCS / (|a| + |b|); 1 for two empty texts.

    One bit per character of ``a``; each character of ``b`` is a few operations on whole words.
    """
    if not a and not b:
        return 1.0
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def without_numbers(line: str) -> str:
    """Without digits, underscores and bold marks, stripped."""
    return "".join(c for c in line.replace("**", "") if not (c.isdigit() and c.isdecimal()) and c != "_").strip()


def repeated_slices(clean: list[str]) -> list[tuple[int, int]]:
    """[start, end) line ranges of lines that each resemble the next non-blank one.

    Runs are cut at gaps of more than three lines; ranges of fifteen lines or fewer are left alone.
    """
    n, after = len(clean), len(clean) - 1
    marked: set[int] = set()
    for i in range(n - 2, -1, -1):
        if clean[i + 1] or i + 1 == n - 1:
            after = i + 1
        x, y = clean[i], clean[after]
        if 3 < len(x) < 200 and 3 < len(y) < 200 and not x.startswith("[MISSING_PAGE") and (x == y or ratio(x, y) > ALIKE):
            marked.update(range(i, after))
    ids = sorted(marked)
    runs: list[list[int]] = []
    for i in ids:
        if runs and i - runs[-1][-1] <= 3:
            runs[-1].append(i)
        else:
            runs.append([i])
    return [(r[0], r[-1] + 2) for r in runs if r[-1] + 2 - r[0] > 15]


def _own_part(before: str, line: str) -> int:
    """Characters at the end of ``line`` from where it stops repeating the line before, digits aside."""
    letters = [c for c in before if not c.isnumeric()]
    places = [k for k, c in enumerate(line) if not c.isnumeric()]
    for t, c in enumerate(letters):
        if t >= len(places):
            return 0
        if line[places[t]] != c:
            return len(line) - places[t] - 1
    return len(line) - places[len(letters) - 1] - 1 if letters and len(places) >= len(letters) else 0


def repeated_block(lines: list[str], clean: list[str], start: int, end: int) -> str:
    """The text to take out for one range: widened while lines stay alike, without what the next page adds."""
    base, first, last, in_list = clean[start], start, end, False
    for i in range(max(0, start - 1), max(0, start - 5), -1):
        if not lines[i]:
            continue
        if lines[i] == "## References":
            first = i
            break
        if ratio(base, clean[i]) < ALIKE:
            item = without_numbers(lines[max(0, i - 1)].partition("* [")[2])
            first = i if len(item) >= 0.75 * len(base) and ratio(base, item) < ALIKE else i + 1
            in_list = True
            break
    for i in range(min(len(lines), end), min(len(lines), end + 5)):
        if ratio(base, clean[i]) < ALIKE:
            last = i
            break
    last = min(last, len(lines) - 1)
    block = "\n".join(lines[first : last + 1])
    if in_list and "* [" in block:
        block = block[block.index("* [") :]
    spare = _own_part(lines[last - 1], lines[last])
    return (block[:-spare] if spare > 0 else block).strip()


def without_repeated_references(text: str) -> str:
    """Ranges of repeating lines become a missing-page marker, and so does the heading above one."""
    lines = text.split("\n")
    clean = [without_numbers(x) for x in lines]
    blocks = [repeated_block(lines, clean, *s) for s in repeated_slices(clean)]
    for block in reversed(blocks):
        if block:
            text = text.replace(block, MISSING)
    return re.sub(r"## References\n+(?=\[MISSING_PAGE_POST(?::\d+)?\])", "\n\n", text)


# -- headings -----------------------------------------------------------------
def _heading(line: str) -> str | None:
    """What follows the marks and the blank of a heading line."""
    bare = line.lstrip("#")
    return bare[1:] if line[:1] == "#" and bare[:1] == " " else None


def plain_long_headings(text: str, least: int = 100) -> str:
    """Headings of ``least`` characters or more are text: marks, number and one sign go, as far as the rest stays long enough."""
    out = []
    for line in text.split("\n"):
        body = _heading(line)
        if body is not None and len(body) >= least:
            digits = len(body) - len(body.lstrip("0123456789"))
            sign = digits < len(body) and not (body[digits].isalnum() or body[digits] == "_")
            blank = body[digits + sign : digits + sign + 1] == " "
            line = body[min(digits + sign + blank, len(body) - least) :]
        out.append(line)
    return "\n".join(out)


def _only_numerals(body: str) -> bool:
    parts = body.rstrip().split(".")
    if len(parts) > 1 and not parts[0]:
        parts = parts[1:]
    return all(p and set(p) <= _NUMERALS for p in parts) or not body.strip()


def without_empty_headings(text: str) -> str:
    """Headings of numerals alone leave one empty line for themselves and the blank lines behind them."""
    out: list[str] = []
    swallow = False
    for line in text.split("\n"):
        if swallow and not line.strip():
            continue
        body = _heading(line)
        swallow = body is not None and _only_numerals(body)
        out.append("" if swallow else line)
    return "\n".join(out)


def without_last_heading(text: str) -> str:
    """A heading on the last line of several is most likely made up."""
    head, cut, last = text.rpartition("\n")
    return head if cut and _heading(last) is not None else text


# -- references, formulas, footnotes -------------------------------------------
def _after_number(line: str) -> int:
    """Position behind ``* [n]`` at the start of a line, else -1."""
    close = line.find("]") if line.startswith("* [") else -1
    return close + 1 if close > 3 and line[3:close].isdecimal() else -1


def _initials(s: str) -> int:
    """How many initials (A to W, dots, blanks around them) open the text."""
    n, k = 0, 0
    while True:
        at = k + (s[k : k + 1].isspace())
        if not ("A" <= s[at : at + 1] <= "W") or s[at + 1 : at + 2] != ".":
            return n
        at += 1
        while s[at : at + 1] == ".":
            at += 1
        k = at + s[at : at + 1].isspace()
        n += 1


def mended_references(text: str) -> str:
    """Reference lines of ten initials or more become empty; empty brackets behind the number go."""
    out = []
    for line in text.split("\n"):
        at = _after_number(line)
        if at > 0 and _initials(line[at:]) >= 10:
            line = ""
        elif at > 0 and line.startswith("[]", at):
            line = line[:at] + line[at + 2 :]
        out.append(line)
    return "\n".join(out)


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def without_lone_ends(text: str) -> str:
    """A single character that a blank line parts from the rest goes at either end."""
    if len(text) >= 3 and _word(text[0]) and text[1:3] == "\n\n":
        text = text[3:]
    if len(text) >= 3 and _word(text[-1]) and text[-3:-1] == "\n\n":
        text = text[:-3]
    return text


_SIGN = "[a-zA-Z0-9]"
_SCRIPTED = re.compile(rf"(?P<before>[\s.,()])_(?P<base>{_SIGN})__{_SIGN}{{0,2}}(?P<script>{_SIGN})_(?P<after>[\s.,:()])")
_SINGLE = re.compile(rf"(?P<before>[\s.,\d])_(?P<base>{_SIGN})_(?P<after>[\s.,\d;])")


def underscored_math(text: str) -> str:
    """``_x__1_`` and ``_x_`` as inline formulas; of a longer script its last sign stays."""
    text = _SCRIPTED.sub(lambda m: f"{m['before']}\\({m['base']}_{{{m['script']}}}\\){m['after']}", text)
    return _SINGLE.sub(lambda m: f"{m['before']}\\({m['base']}\\){m['after']}", text)


def mended_footnotes(text: str) -> str:
    """Command names in front of footnote texts go, and so do footnote blocks inside a line."""
    lines = text.split("\n")
    for k, line in enumerate(lines):
        for name in (": footnotetext:", ": thanks:") if k and line.startswith("Footnote ") else ():
            head, found, tail = line.partition(name)
            if found and (k == len(lines) - 1 or not lines[k + 1]):
                lines[k] = f"{head}: {tail.lstrip(''.join({c for c in tail if not _word(c)}))}"
                break
    out = []
    for line in lines:
        while (a := line.find("[FOOTNOTE:")) >= 0:
            close = line.find("]", a + 11)
            end = line.find("[END_FOOTNOTE]", close) if close > 0 else -1
            if end < 0:
                break
            line = line[:a] + line[end + len("[END_FOOTNOTE]") :]
        out.append(line)
    return "\n".join(out)


# -- lists ----------------------------------------------------------------------
def _depth(numeral: str) -> int:
    """Dots of a numeral such as 1.2 or iv.1; no depth for anything else."""
    low = numeral.lower()
    if not low or low[0] not in _NUMERALS or not set(low) <= _NUMERALS | {"."} or ".." in low or low.endswith("."):
        return 0
    return low.count(".")


def split_items(text: str) -> str:
    """A list line that holds further items becomes a line an item, indented by the depth of its numeral."""
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if line[:1] not in ("-", "*") or not line[:1] or line[1:2] in ("-", "*"):
            continue
        at = min((p for p in (line.find(f" {m} ", 2) for m in "-*") if p > 0), default=0)
        if not at:
            continue
        mark = line[at + 1] + " "
        out = []
        for i, item in enumerate(line.split(mark)[1:]):
            first, _, rest = item.strip().partition(" ")
            if rest:
                out.append("\n" * (i > 0) + "\t" * _depth(first) + (mark if i or not k else line[0] + " ") + item.strip())
        lines[k] = "".join(out) + "\n" * (k == len(lines) - 1)
    return "\n".join(lines)


def spaced_end(text: str, words: Set[str] | None = None) -> str:
    """Blanks or a blank line at the ends, so that pages can be joined.

    A text that ends in a word of ``words`` gets a blank; without a word list every such text does.
    """
    if text.endswith((".", "}")):
        text += "\n\n"
    if len(text) == 1 and (text in ",;:" or text.isascii() and (text.isupper() or text.isdigit())):
        return text + " "
    if text.startswith(("#", "**", "\\begin")):
        return "\n\n" + text
    if text.rpartition("\n")[2].startswith(("#", "Figure", "Table")):
        return text + "\n\n"
    return text + " " if words is None or text.rpartition(" ")[2] in words else text


# -- tables ---------------------------------------------------------------------
# fixed values: joined or empty table commands and what stands for them, in this order
TABLE_FORMS = [("\\begin{table} \\begin{tabular}", "\\begin{table}\n\\begin{tabular}"), ("\\end{tabular} \\end{table}", "\\end{tabular}\n\\end{table}"), ("\\end{table} Tab", "\\end{table}\nTab")]
EMPTY_FORMS = [("\\begin{tabular}{l l}  & \\\\ \\end{tabular}", ""), ("\\begin{tabular}{}\n\n\\end{tabular}", ""), ("\\begin{array}[]{", "\\begin{array}{")]
TABLE_LIMITS = {"\\begin{tabular}": 15, "\\multicolumn": 60, "&": 400}


def mended_tables(text: str) -> str:
    """Lines that cannot be tables go, table commands get lines of their own, empty tables go."""
    for line in text.split("\n"):
        if any(line.count(mark) > most for mark, most in TABLE_LIMITS.items()):
            text = text.replace(line, "")
    for old, new in TABLE_FORMS:
        text = text.replace(old, new)
    lines = text.split("\n")
    for k, line in enumerate(lines):
        at = line.rfind("\\begin{tab")
        if at > 0:
            lines[k] = line[:at] + "\n" + line[at:]
    text = "\n".join(lines)
    for old, new in EMPTY_FORMS:
        text = text.replace(old, new)
    return _without_blank_tabulars(text)


def _without_blank_tabulars(text: str) -> str:
    start, end = "\\begin{tabular}{", "\\end{tabular}"
    out, at = [], 0
    while (a := text.find(start, at)) >= 0:
        close = text.find("}", a + len(start))
        stop = text.find(end, close) if close > 0 else -1
        if stop < 0:
            break
        spec, body = text[a + len(start) : close], text[close + 1 : stop]
        bare = body[:-1] if body.endswith(" ") else None
        if bare is not None:
            bare = bare.removesuffix("\\\\")
        blank = len(spec) >= 2 and set(spec) <= set("clr ") and bare is not None and not bare.strip(" &\t\n")
        out.append(text[at:a] if blank else text[at : stop + len(end)])
        at = stop + len(end)
    return "".join([*out, text[at:]])


def without_leftovers(text: str) -> str:
    """Repeated initials, headings of nothing or one sign, lone dots and surplus blank lines go."""
    mark = "**S. A. B.**"
    lines: list[str] = []
    for is_mark, run in groupby(text.split("\n"), key=lambda x: x == mark):
        held = list(run)
        lines += [] if is_mark and len(held) > 1 else held
    out = []
    for line in lines:
        body = _heading(line)
        bare = line[:1] == "#" and not line.strip("#")
        one = body is not None and len(body) == 1 and (_word(body) or body == "[")
        out.append("" if bare or one or line.rstrip() == "." and line[:1] == "." else line)
    return re.sub("\n{3,}", "\n\n", "\n".join(out))


# -- portable markdown ------------------------------------------------------------
_LINK = frozenset(".,@?^=%&:/~+#-_")
_SCHEMES = ("https://", "http://", "ftp://")


def _number_of(s: str) -> str | None:
    """The equation number of ``(n)``: digits and dots, then at most one letter."""
    body = s[1:-1]
    core = body[:-1] if body[-1:].isascii() and body[-1:].isalpha() else body
    return body if s[:1] == "(" and s[-1:] == ")" and core and all(c.isdecimal() or c == "." for c in core) else None


def tagged_equation(line: str) -> str:
    """A display formula with its number beside it holds the number as a tag."""
    if line.startswith("("):
        number, _, rest = line.partition(" ")
        if _number_of(number) and rest.startswith("\\[") and rest.endswith("\\]") and len(rest) > 4:
            return f"\\[{rest[2:-2]} \\tag{{{_number_of(number)}}}\\]"
    elif line.startswith("\\["):
        close = line.find("\\] (", 3)
        while close > 0:
            number, _, rest = line[close + 3 :].partition(" ")
            if _number_of(number) and (not rest or rest.startswith("\\[") and rest.endswith("\\]") and len(rest) > 4):
                return f"\\[{line[2:close]} \\tag{{{_number_of(number)}}}\\]" + (f" {rest}" if rest else "")
            close = line.find("\\] (", close + 1)
    return line


def _link_end(text: str, at: int) -> int:
    """End of the address whose host begins at ``at``, or ``at`` if there is none: dotted host, no closing mark."""
    end = at
    while end < len(text) and (text[end].isalnum() or text[end] in _LINK):
        end += 1
    while end > at and text[end - 1] in ".,:":
        end -= 1
    host, dot, rest = text[at:end].partition(".")
    named = bool(host) and all(c.isalnum() or c in "_-" for c in host)
    return end if named and dot and len(rest) > 1 and (rest[0].isalnum() or rest[0] in "_-") else at


def linked(text: str) -> str:
    """Addresses become links that show themselves."""
    out, at = [], 0
    while True:
        found = [(p, s) for s in _SCHEMES if (p := text.find(s, at)) >= 0]
        if not found:
            return "".join([*out, text[at:]])
        start, scheme = min(found)
        end = _link_end(text, start + len(scheme))
        if end == start + len(scheme):
            out.append(text[at:end])
        else:
            out.append(f"{text[at:start]}[{text[start:end]}]({text[start:end]})")
        at = end


def fenced(text: str) -> str:
    """Code fences stand on lines of their own."""
    pieces = text.split("```")
    out = [pieces[0]]
    k = 1
    while k < len(pieces):
        if k + 1 < len(pieces) and pieces[k].strip():
            out += [f"```\n{pieces[k].strip()}\n```", pieces[k + 1]]
            k += 2
        else:
            out += ["```", pieces[k]]
            k += 1
    return "".join(out)


def markdown_compatible(text: str | None) -> str | None:
    """Equation numbers as tags, bold forms as one form, addresses as links, code fences apart."""
    if text is None:
        return None
    text = "\n".join(map(tagged_equation, text.split("\n"))).replace("\\. ", ". ")
    text = text.replace("\\bm{", "\\mathbf{").replace("{\\\\bm ", "\\mathbf{")
    for opening in ("\\mbox{\\boldmath$", "\\mbox{ \\boldmath$"):
        head, *rest = text.split(opening)
        for piece in rest:
            body, close, tail = piece.partition("$}")
            head += f"\\mathbf{{{body}}}{tail}" if close and "\n" not in body else opening + piece
        text = head
    return fenced(linked(text))


#: The steps in order.
STEPS: list[Callable[[str], str]] = [
    plain_long_headings,
    str.strip,
    lambda s: s.replace("\n* [leftmargin=*]\n", "\n"),
    without_empty_headings,
    without_last_heading,
    truncate_repetitions,
    without_repeated_references,
    mended_references,
    without_lone_ends,
    underscored_math,
    mended_footnotes,
    split_items,
    spaced_end,
    mended_tables,
    without_leftovers,
]


def postprocessed(text: str | None, portable: bool = True) -> str | None:
    """All steps over one generated text; null stays null.  ``portable`` adds ``markdown_compatible``."""
    if text is None:
        return None
    for step in STEPS:
        text = step(text)
    return markdown_compatible(text) if portable else text
