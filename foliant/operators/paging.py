"""Splitting a document's markup into the pages of its extracted text.

The sequential part is row-local: one document with the text lines of its pages
goes in, its pages come out, so documents spread over all tasks and nothing is
shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field
from itertools import pairwise
from typing import NamedTuple

from foliant.functions import markup as M
from foliant.functions.alignment import Found, align, align_last
from foliant.functions.formulas import plain_formulas
from foliant.functions.text import LINE_TAGS

#: Lines around the pointer in which a line is sought.
WINDOW = 20
#: Index words that are looked up for one page line, and the score at which a search ends early.
WORDS, GOOD = 5, 0.9
#: Boundaries below this score are not used.
LEAST_BOUNDARY = 0.05
_SQUEEZE = str.maketrans("", "", "\n\t\u00a0 ")
_WORD = re.compile(r"[\u4e00-\u9fff]|[^\W\u4e00-\u9fff]+")
_MARKS = {"[BOLD_TEMP]": "", "[END_BOLD_TEMP]": "", "[ITALIC_TEMP]": "", "[END_ITALIC_TEMP]": ""}
_MARKDOWN = {"[BOLD_TEMP]": "**", "[END_BOLD_TEMP]": "**", "[ITALIC_TEMP]": "_", "[END_ITALIC_TEMP]": "_"}


def squeezed(line: str) -> str:
    return line.translate(_SQUEEZE)


def too_short(s: str) -> bool:
    return len(s) <= 8


def digit_line(s: str) -> bool:
    return re.sub("[-_ ]", "", s).strip("{}[]<>()（）").isdigit()


def without_abstract(s: str) -> str:
    return s[8:].strip(".—") if s.startswith("abstract") and len(s) > 30 else s


def accepted(length: int, score: float) -> bool:
    return score > (0.5 if length > 30 else 0.75)


def length_penalty(part: str, whole: str, least: float = 0.03) -> float:
    """1 from a length share of ``least`` on, below it in proportion, 0.1 at least."""
    share = len(part.strip()) / max(1, len(whole.strip()))
    return 1.0 if share >= least else max(share / least, 0.1)


def words_of(line: str) -> list[str]:
    return _WORD.findall(line)


def _runs(words: list[str], n: int) -> list[str]:
    return [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]


def grams(words: list[str], index: bool) -> list[str]:
    """Distinct n-grams of a line in order of first place, for the index or for a page line.

    Longer lines give longer grams; single characters give 4-grams, or one gram in all.
    """
    if not words:
        return []
    if max(map(len, words)) == 1:
        found = _runs(words, 4) if len(words) > 3 else [" ".join(words)]
    elif index and len(words) > 8:
        found = _runs(words, 3) + _runs(words, 2)
    elif not index and len(words) > 10:
        found = _runs(words, 3)
    elif not index and len(words) > 5:
        found = _runs(words, 2)
    else:
        found = [w for w in words if len(w) > 1] + _runs(words, 2)
    return list(dict.fromkeys(found))


class Line(NamedTuple):
    """A document line for matching: its number, its content, and that squeezed."""

    number: int
    content: str
    tight: str


@dataclass
class Side:
    """Lines of one content type and their inverted index."""

    lines: list[Line] = field(default_factory=list)
    index: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))

    def add(self, number: int, content: str) -> None:
        for g in grams(words_of(content), index=True):
            self.index[g].append(len(self.lines))
        self.lines.append(Line(number, content, squeezed(content)))

    def candidates(self, words: list[str]) -> list[int]:
        known = [w for w in words if w in self.index][:WORDS]
        return sorted({k for w in known for k in self.index[w]})

    def best(self, query: str, candidates: list[int]) -> tuple[float, int] | None:
        """The first candidate with the best score, none after a good one being tried, if the score is accepted."""
        top: tuple[float, int] | None = None
        for k in candidates:
            score = align(self.lines[k].content, query).score
            if top is None or score > top[0]:
                top = (score, k)
            if score > GOOD:
                break
        return top if top is not None and accepted(len(query), top[0]) else None


class Match(NamedTuple):
    """A page line and the document line that it was found in, if any."""

    page_line: int
    text: str
    number: int | None = None
    score: float = 0.0
    ordered: bool = True


def sides(lines: list[str], tags: list[str]) -> tuple[Side, Side]:
    """Ordered and unordered lines with content."""
    plain = plain_formulas("\n".join(lines))
    for mark, put in _MARKS.items():
        plain = plain.replace(mark, put)
    ordered, unordered = Side(), Side()
    for number, (line, tag) in enumerate(zip(plain.split("\n"), tags, strict=False)):
        content = M.match_text(line.strip(), tag)
        if content:
            (ordered if LINE_TAGS[tag] == "ordered" else unordered).add(number, content)
    return ordered, unordered


class Matcher:
    """Matches page lines in turn; the pointer goes from line to line and from page to page."""

    def __init__(self, ordered: Side, unordered: Side) -> None:
        self.ordered, self.unordered, self.pointer = ordered, unordered, 0

    def _whole(self, tight: str, line: Line) -> bool:
        return tight in line.tight or not too_short(line.tight) and line.tight in tight

    def _contained(self, tight: str) -> tuple[Side, int] | None:
        """The nearest ordered line that holds the page line or is held by it; backward ones count half a window more.

        Ordered hits that all lie outside the window rule unordered ones out too.
        """
        lines = self.ordered.lines
        far = lambda k: k - self.pointer if k >= self.pointer else self.pointer - k + WINDOW // 2
        window = range(max(0, self.pointer - WINDOW), min(len(lines), self.pointer + WINDOW + 1))
        for k in sorted(window, key=far):
            if self._whole(tight, lines[k]):
                return self.ordered, k
        if any(self._whole(tight, x) for x in lines):
            return None
        hit = next((k for k, x in enumerate(self.unordered.lines) if self._whole(tight, x)), None)
        return None if hit is None else (self.unordered, hit)

    def _indexed(self, tight: str, words: list[str]) -> tuple[Side, int, float] | None:
        near = [k for k in self.ordered.candidates(words) if self.pointer <= k <= self.pointer + WINDOW]
        a, b = self.ordered.best(tight, near), self.unordered.best(tight, self.unordered.candidates(words))
        if b is not None and (a is None or b[0] > a[0]):
            return self.unordered, b[1], b[0]
        return None if a is None else (self.ordered, a[1], a[0])

    def match(self, k: int, text: str) -> Match:
        tight = squeezed(text)
        if too_short(tight):
            return Match(k, text)
        tight = without_abstract(tight)
        if digit_line(tight):
            return Match(k, text)
        whole = self._contained(tight)
        found = (*whole, 1.0) if whole else self._indexed(tight, grams(words_of(text), index=False))
        if found is None:
            return Match(k, text)
        side, at, score = found
        if side is self.ordered:
            self.pointer = at
        return Match(k, text, side.lines[at].number, score, side is self.ordered)


@dataclass
class Page:
    numbers: list[int] = field(default_factory=list)
    matches: list[Match] = field(default_factory=list)
    valid: bool = True


def assign(pages: list[list[Match]], ordered: list[bool]) -> list[Page]:
    """Document lines of each page: the ordered ones strictly forward, gaps filled, unordered ones once."""
    matched = {m.number for page in pages for m in page if m.number is not None}
    out: list[Page] = []
    used: set[int] = set()
    pointer = -1
    for matches in pages:
        page, before, opening = Page(), out[-1] if out else None, True
        last: int | None = None
        for k, m in enumerate(matches):
            if m.number is None:
                continue
            repeats, last = m.number == last, m.number
            if repeats:
                if page.matches and page.matches[-1].number == m.number:
                    page.matches.append(m)
                    opening = False
                continue
            if not ordered[m.number]:
                if m.number not in used:
                    page.matches.append(m)
                    page.numbers.append(m.number)
                continue
            if m.number < pointer:
                continue
            if m.number > pointer:
                gap = [g for g in range(pointer + 1, m.number) if ordered[g]]
                if any(g in matched and g not in used for g in gap):
                    continue
                if k == 0:
                    if before is not None:
                        before.numbers += gap
                else:
                    if opening and gap:
                        page.valid = False
                        if before is not None:
                            before.valid = False
                    page.numbers += gap
                pointer = m.number
            opening = False
            page.matches.append(m)
            page.numbers.append(m.number)
        out.append(page)
        used.update(page.numbers)
    return out


class Region(NamedTuple):
    page: int
    first: Match
    last: Match


def regions(pages: list[Page], number: int) -> list[Region]:
    """Runs of the page lines that were found in one document line; a page end or an unordered line between parts them."""
    out: list[Region] = []
    for p, page in enumerate(pages):
        breaks = {m.page_line for m in page.matches if not m.ordered}
        for m in sorted((m for m in page.matches if m.number == number), key=lambda m: m.page_line):
            if out and out[-1].page == p and not any(k in breaks for k in range(out[-1].last.page_line + 1, m.page_line)):
                out[-1] = out[-1]._replace(last=m)
            else:
                out.append(Region(p, m, m))
    return out


def _edge(line: str, match: Match, last: bool) -> Found | None:
    query = " ".join(match.text.split()).lower()
    if not query or not line:
        return None
    found = (align_last if last else align)(line.lower(), query)
    return found if found.score >= LEAST_BOUNDARY else None


def segments(line: str, runs: list[Region]) -> list[tuple[int, str]]:
    """(page, text) of a line that several regions share, cut where one region ends and the next begins.

    Text between an end and the next beginning goes to neither.  Empty if no boundary was found.
    """
    marks: list[tuple[int, str, int]] = []
    for a, b in pairwise(runs):
        for kind, found in (("last", _edge(line, a.last, True)), ("first", _edge(line, b.first, False))):
            if found is not None:
                marks.append((found.start, kind, found.end))
    if not marks:
        return []
    marks.sort(key=lambda m: m[:2])
    ranges, start, k = [], 0, 0
    while k + 1 < len(marks):
        if marks[k][1] == "last" and marks[k + 1][1] == "first":
            if start <= marks[k][2]:
                ranges.append((start, marks[k][2]))
            start = marks[k + 1][0]
            k += 1
        k += 1
    if start < len(line):
        ranges.append((start, len(line) - 1))
    return [(runs[min(i, len(runs) - 1)].page, line[a : b + 1]) for i, (a, b) in enumerate(ranges) if line[a : b + 1].strip()]


def merged_gap(line: str, end: int, start: int, last: str, first: str) -> tuple[int, int]:
    """Where the text between a segment's end and the next one's start goes: to the side whose page line fits longer."""
    if start == end + 1:
        return end, start

    def common(a: str, b: str) -> int:
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    back = common(line[: end + 1][::-1].strip().lower(), last[::-1].strip().lower())
    ahead = common(line[start:].strip().lower(), first.strip().lower())
    return (end, end + 1) if back > ahead else (start - 1, start)


def split_markup(doc: str | None, pages: list[list[str]] | None) -> list[dict] | None:
    """text and valid of each page, for a document and the lower-cased text lines of its pages; null stays null."""
    if doc is None or pages is None:
        return None
    lines, tags, objects = M.parsed(doc)
    matcher = Matcher(*sides(lines, tags))
    found = [[matcher.match(k, text) for k, text in enumerate(page)] for page in pages]
    placed = assign(found, [LINE_TAGS[t] == "ordered" for t in tags])
    count: dict[int, int] = defaultdict(int)
    for page in placed:
        for n in page.numbers:
            count[n] += 1
    cut = {n: got for n, c in sorted(count.items()) if c > 1 and (got := segments(lines[n], regions(placed, n)))}
    out = []
    for p, page in enumerate(placed):
        seen: dict[int, int] = defaultdict(int)
        parts = []
        for n in page.numbers:
            if n in cut:
                own = [text for at, text in cut[n] if at == p]
                parts += own[seen[n] : seen[n] + 1]
                seen[n] += 1
            else:
                parts.append(lines[n])
        whole = [M.wrapped(x) for x in parts if x.strip()]
        text = "\n".join(objects.get(x, x) for x in whole)
        for mark, put in _MARKDOWN.items():
            text = text.replace(mark, put)
        out.append({"text": text, "valid": page.valid})
    return out
