"""Tolerant alignment of a short query in a longer text."""

from __future__ import annotations

from typing import NamedTuple

#: How far a mismatch looks ahead on either side, and how many paired skips one attempt may make.
GAP, SKIPS = 3, 3


class Found(NamedTuple):
    """Score, first and last position (inclusive; -1 where nothing matched) and matched characters."""

    score: float
    start: int
    end: int
    matched: int


NOWHERE = Found(0.0, -1, -1, 0)


def _attempt(content: str, query: str, i: int, j: int) -> tuple[int, int, int]:
    """Matched characters, last matched position and breaks of a walk from content[i], query[j]."""
    matched, last, breaks = 0, -1, 0
    while i < len(content) and j < len(query):
        if content[i] == query[j]:
            step_i, step_j, hit = i, j, True
        elif (ahead := content.find(query[j], i + 1, i + 1 + GAP)) >= 0:
            step_i, step_j, hit = ahead, j, True
            breaks += 1
        elif (ahead := query.find(content[i], j + 1, j + 1 + GAP)) >= 0:
            step_i, step_j, hit = i, ahead, True
            breaks += 1
        elif breaks < SKIPS:
            step_i, step_j, hit = i, j, False
            breaks += 1
        else:
            break
        if hit:
            matched, last = matched + 1, step_i
        i, j = step_i + 1, step_j + 1
    return matched, last, breaks


def align(content: str, query: str) -> Found:
    """The best attempt at the query in the content.

    A query that stands in the content scores 1 at its first place.  Otherwise
    each content position whose trigram is in the query starts a walk at that
    trigram's first place in the query; the walk with strictly more matched
    characters wins, and scores them over the query's length and its own breaks.
    """
    if not content or not query:
        return NOWHERE
    at = content.find(query)
    if at >= 0:
        return Found(1.0, at, at + len(query) - 1, len(query))
    places: dict[str, int] = {}
    for j in range(len(query) - 2):
        places.setdefault(query[j : j + 3], j)
    best, start = (0, -1, 0), -1
    for i in range(len(content) - 2):
        j = places.get(content[i : i + 3])
        if j is not None:
            got = _attempt(content, query, i, j)
            if got[0] > best[0]:
                best, start = got, i
    matched, end, breaks = best
    return Found(matched / (len(query) + breaks), start, end, matched) if matched else NOWHERE


def align_last(content: str, query: str) -> Found:
    """Forward and backward alignment; the one that ends later in the content, forward if they end together."""
    forward = align(content, query)
    back = align(content[::-1], query[::-1])
    if back.start < 0:
        return forward
    n = len(content)
    mirrored = Found(back.score, n - back.end - 1, n - back.start - 1, back.matched)
    return forward if forward.end >= mirrored.end else mirrored
