"""Staircase classifier: page numbers that rise with the position in a document."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from itertools import groupby, pairwise
from statistics import median

#: Deviations from the median that a class may spread over.
SPREAD = 5


def limits(positions: list[int], labels: list[int], classes: int, domain: int) -> tuple[list[int], list[int]]:
    """Earliest and latest boundary behind each class but the last, from medians and median deviations.

    Position 0 does not count; a class without positions has the median of the
    one before it and spreads over half a class.
    """
    medians: list[float] = []
    spreads: list[float] = []
    for c in range(classes):
        own = [p for p, x in zip(positions, labels, strict=True) if x == c and p]
        if own:
            medians.append(median(own))
            spreads.append(SPREAD * median(abs(p - medians[-1]) for p in own))
        else:
            medians.append(medians[-1] if medians else 0.0)
            spreads.append(SPREAD * domain / classes / 2)
    pairs = [(medians[c] - spreads[c], medians[c + 1] + spreads[c + 1]) for c in range(classes - 1)]
    return [int(min(p)) for p in pairs], [int(max(p)) for p in pairs]


def fit(positions: list[int] | None, labels: list[int] | None, classes: int, domain: int, patience: int = 10) -> list[float] | None:
    """Boundaries between ``classes`` consecutive classes over positions 0 to domain - 1.

    Boundary by boundary, the place that leaves the two classes around it least
    mixed (count less squared hits over count) is taken, the last of equal ones,
    inside limits from ``limits``.  The search ends early once it is more than a
    class away from the best place and impurity has not risen for ``patience``
    places.  Counts up to each position make every trial a few sums.
    """
    if positions is None or labels is None:
        return None
    if classes < 2 or domain < 1:
        return []
    back, ahead = limits(positions, labels, classes, domain)
    total = [0] * (domain + 2)
    hits = [[0] * (domain + 2) for _ in range(classes)]
    for p, c in zip(positions, labels, strict=True):
        total[min(p, domain) + 1] += 1
        if c < classes:
            hits[c][min(p, domain) + 1] += 1
    for counts in (total, *hits):
        for k in range(1, len(counts)):
            counts[k] += counts[k - 1]

    def mixed(c: int, low: int, high: int) -> float:
        """Impurity of class ``c`` over positions above ``low``, up to ``high``."""
        a, b = min(low, domain) + 1, min(high, domain) + 1
        n = total[b] - total[a] if b > a else 0
        return n - (hits[c][b] - hits[c][a]) ** 2 / n if n else 0.0

    edges = [0, *range(domain - classes, domain - 1), domain]
    edges = [max(0, e) for e in edges]
    last = -0.5
    for n in range(classes - 1):
        chosen, best = ahead[n], float("inf")
        recent: deque[float] = deque(maxlen=patience)
        start = max(0, back[n - 1]) if n else 0
        stop = min(domain, ahead[n + 1]) if n + 2 < classes else domain - 1
        for i in range(start, stop):
            value = mixed(n, edges[n], i) + mixed(n + 1, i, edges[n + 2])
            recent.append(value)
            if value <= best:
                best, chosen, last = value, i, i + 0.5
            elif i - last > domain / classes and len(recent) == patience and all(x >= y for x, y in pairwise(recent)):
                break
        edges[n + 1] = back[n] = ahead[n] = chosen
    return [min(max(e, 0), domain - 1) + 0.5 for e in edges[1:-1]]


def stairs(items: list[tuple[int, int, int | None]] | None) -> tuple[int, list[float], float] | None:
    """classes, bounds and the share of rows they class right; items (number, part, quantity) in order, each a page of so many rows, some with the page before's label.

    Items alike in number and part end at one place.  A quantity below 1 counts
    down from 1, as a sequence does; items without one have no rows.
    """
    rows: list[tuple[int, int]] = []
    end = classes = page = 0
    for _, alike in groupby(items or [], key=lambda i: i[:2]):
        quantities = [q for *_, q in alike]
        end += sum(q for q in quantities if q is not None)
        for q in quantities:
            if q is not None:
                at, classes = end - q, page + 1
                rows += [(p, max(page - 1, 0) if p >= 0 and p % 11 == 5 else page) for p in range(at, at + (q if q > 0 else 2 - q))]
            page += 1
    if not rows:
        return None
    rows.sort()
    positions, labels = map(list, zip(*rows, strict=True))
    bounds = fit(positions, labels, classes, positions[-1] + 1)
    floors = sorted(b // 1 for b in bounds)
    right = sum(bisect_left(floors, p) == x for p, x in rows)
    return classes, bounds, right / len(rows)
