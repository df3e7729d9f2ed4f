"""Detected boxes and table cells: duplicates, columns, matches and table scores."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import kernels as K
from foliant.functions import metrics as M

# fixed values: labels of a layout detector by group, and the groups that a page's head and foot take
GROUPS = {"title": ["文章标题"], "author": ["作者"], "catalog": ["目录"], "body": ["子标题", "正文", "公式", "注释"], "reference": ["参考文献"], "chart": ["图片", "图片标题", "表格", "表格标题", "表格注释"], "code": ["算法", "算法标题", "代码", "代码标题"], "fragment": ["片段", "片段标题"], "innernote": ["间注"], "sidenote": ["旁注"]}
HEAD, FOOT = ["文章标题", "作者"], ["注释", "旁注"]
BODY = ["目录", "子标题", "正文", "公式", "参考文献", *GROUPS["chart"], *GROUPS["code"], *GROUPS["fragment"], "间注"]
# fixed values
ALSO = {"子标题": "subtitle", "注释": "footnote"}
#: Thresholds of table scores; a score weighs as much as its threshold.
THRESHOLDS = (0.6, 0.7, 0.8, 0.9)


class Box(NamedTuple):
    box_id: int
    x1: float
    y1: float
    x2: float
    y2: float
    score: float

    def area(self) -> float:
        return (self.x2 - self.x1) * (self.y2 - self.y1)

    def overlap(self, other: Box) -> float:
        return max(0.0, min(self.x2, other.x2) - max(self.x1, other.x1)) * max(0.0, min(self.y2, other.y2) - max(self.y1, other.y1))


def deduped(boxes: list | None, least: float = 0.7, inside: float = 0.9) -> list[int] | None:
    """Ids that stay, in input order.

    Of two boxes that overlap by more than ``least`` the lower score goes, the
    later one of equal scores; else one that lies inside the other by more than
    ``inside``.  A box that went is still compared with later ones, but for its
    own comparisons, which end.
    """
    if boxes is None:
        return None
    held = [Box(*b) for b in boxes]
    gone: set[int] = set()
    for i, a in enumerate(held):
        for j in range(i + 1, len(held)):
            b = held[j]
            both = a.overlap(b)
            if not both:
                continue
            if both / (a.area() + b.area() - both) > least:
                loser = i if a.score < b.score else j
            elif both / a.area() > inside:
                loser = i
            elif both / b.area() > inside:
                loser = j
            else:
                continue
            gone.add(loser)
            if loser == i:
                break
    return [b.box_id for k, b in enumerate(held) if k not in gone]


def greedy_matches(truth: list | None, found: list | None, least: float) -> list[tuple[int, int]] | None:
    """(truth id, found id): each true box in turn takes the first box left that it overlaps by ``least``."""
    if truth is None or found is None:
        return None
    left = [Box(*b) for b in found]
    out = []
    for t in (Box(*b) for b in truth):
        for k, b in enumerate(left):
            both = t.overlap(b)
            if both and both / (t.area() + b.area() - both) >= least:
                out.append((t.box_id, b.box_id))
                del left[k]
                break
    return out


#: Pairs of boxes that are compared at once; a page is never parted.
PAIRS = 1 << 18


def _pages(a: pa.Array) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """Boxes of a list column: ids, columns x1, y1, x2, y2, score, and where each page's begin; a null page has none."""
    ids, *numbers = a.flatten().flatten()
    return ids, [c.to_numpy(zero_copy_only=False) for c in numbers], np.concatenate([[0], np.cumsum(a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _overlaps(a: list[np.ndarray], i: np.ndarray, b: list[np.ndarray], j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common area of boxes i of ``a`` and j of ``b``, and their own areas."""
    (ax, ay, au, av, _), (bx, by, bu, bv, _) = a, b
    both = np.maximum(0.0, np.minimum(au[i], bu[j]) - np.maximum(ax[i], bx[j])) * np.maximum(0.0, np.minimum(av[i], bv[j]) - np.maximum(ay[i], by[j]))
    return both, (au[i] - ax[i]) * (av[i] - ay[i]), (bu[j] - bx[j]) * (bv[j] - by[j])


def _pairs(first: np.ndarray, second: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of every box of one side with every box of the other, page by page, of pages ``low`` to ``high`` - 1."""
    n, m = np.diff(first[low : high + 1]), np.diff(second[low : high + 1])
    i = np.repeat(np.arange(first[low], first[high]), np.repeat(m, n))
    width = np.repeat(m, n)
    ends = np.cumsum(width)
    j = np.arange(len(i)) - np.repeat(ends - width, width) + np.repeat(np.repeat(second[low:high], n), width)
    return i, j


def _spans(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of pages of about ``PAIRS`` pairs."""
    pairs = np.cumsum(np.diff(first) * np.diff(second))
    low = 0
    while low < len(pairs):
        done = pairs[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(pairs, done + PAIRS, side="right")))
        yield low, high
        low = high


def _listed(at: np.ndarray, rows: np.ndarray, items: pa.Array) -> pa.Array:
    """Lists of ``items`` at the rising ``rows``, a list a page."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, at), pa.int32()), items)


def deduped_pages(pages: pa.Array, least: float = 0.7, inside: float = 0.9) -> pa.Array:
    """``deduped`` of many pages at once; a page of more than ``PAIRS`` pairs goes through it alone.

    A box's comparisons depend on no other box's: they end at the first later box that it loses to.
    """
    ids, held, at = _pages(pages)
    stays = np.ones(len(ids), dtype=bool)
    for low, high in _spans(at, at):
        if (at[high] - at[low]) ** 2 > PAIRS and high == low + 1:
            rows = list(zip(range(at[low], at[high]), *(c[at[low] : at[high]].tolist() for c in held), strict=True))
            stays[at[low] : at[high]] = False
            stays[np.array(deduped(rows, least, inside), dtype=np.int64)] = True
            continue
        i, j = _pairs(at, at, low, high)
        i, j = i[i < j], j[i < j]
        both, a, b = _overlaps(held, i, held, j)
        some = both > 0
        i, j, both, a, b = i[some], j[some], both[some], a[some], b[some]
        much = both / (a + b - both) > least
        first = np.where(much, held[4][i] < held[4][j], both / a > inside)
        second = ~first & (much | (both / b > inside))
        until = np.full(at[high] - at[low], len(stays))
        np.minimum.at(until, i[first] - at[low], j[first])
        stays[i[first]] = False
        stays[j[second & (j < until[i - at[low]])]] = False
    return _listed(at, np.flatnonzero(stays), ids.filter(pa.array(stays)))


def matched_pages(truth: pa.Array, found: pa.Array, least: float) -> pa.Array:
    """``greedy_matches`` of many pages at once: only overlaps that are large enough are gone through box by box."""
    truth_ids, t, at = _pages(truth)
    found_ids, f, to = _pages(found)
    out: list[tuple[int, int]] = []
    for low, high in _spans(at, to):
        if (at[high] - at[low]) * (to[high] - to[low]) > PAIRS and high == low + 1:
            sides = (list(zip(range(x[low], x[high]), *(c[x[low] : x[high]].tolist() for c in cs), strict=True)) for x, cs in ((at, t), (to, f)))
            out += greedy_matches(*sides, least)
            continue
        i, j = _pairs(at, to, low, high)
        both, a, b = _overlaps(t, i, f, j)
        hits = both > 0
        hits[hits] = both[hits] / (a[hits] + b[hits] - both[hits]) >= least
        last, taken = -1, set()
        for n, m in zip(i[hits].tolist(), j[hits].tolist(), strict=True):
            if n != last and m not in taken:
                out.append((n, m))
                taken.add(m)
                last = n
    rows = np.array(out, dtype=np.int64).reshape(-1, 2)
    return _listed(at, rows[:, 0], pa.StructArray.from_arrays([truth_ids.take(pa.array(rows[:, 0])), found_ids.take(pa.array(rows[:, 1]))], ["truth_id", "found_id"]))


def clusters(values: list[float], k: int) -> list[int]:
    """Optimal one-dimensional k-means labels, numbered from left to right; ties go to the leftmost cuts.

    Dynamic programme over sorted values with prefix sums.
    """
    order = sorted(range(len(values)), key=lambda i: values[i])
    xs = [values[i] for i in order]
    k = min(k, len(set(xs)))
    one, two = [0.0], [0.0]
    for x in xs:
        one.append(one[-1] + x)
        two.append(two[-1] + x * x)
    cost = lambda a, b: two[b] - two[a] - (one[b] - one[a]) ** 2 / (b - a)
    n = len(xs)
    best = [[0.0] + [float("inf")] * n for _ in range(k + 1)]
    cut = [[0] * (n + 1) for _ in range(k + 1)]
    best[0] = [0.0] + [float("inf")] * n
    for c in range(1, k + 1):
        best[c][0] = float("inf")
        for b in range(c, n + 1):
            best[c][b], cut[c][b] = min((best[c - 1][a] + cost(a, b), a) for a in range(c - 1, b))
    labels, b = [0] * n, n
    for c in range(k, 0, -1):
        a = cut[c][b]
        for i in range(a, b):
            labels[order[i]] = c - 1
        b = a
    return labels


def columns(boxes: list | None, dominant: list | None) -> list[int] | None:
    """Column of each box: none parts boxes if dominant ones are wide, else two or three clusters of their centres.

    The height-weighted mean width over the extent decides: above 0.5 one
    column, below 0.33 three, else two.
    """
    if boxes is None:
        return None
    held, main = [Box(*b) for b in boxes], [Box(*b) for b in dominant or []]
    height = sum(b.y2 - b.y1 for b in main)
    if not main or not held or not height:
        return [0] * len(held)
    mean = sum((b.y2 - b.y1) * (b.x2 - b.x1) for b in main) / height
    share = mean / (max(b.x2 for b in main) - min(b.x1 for b in main))
    if share > 0.5:
        return [0] * len(held)
    return clusters([(b.x1 + b.x2) / 2 for b in held], 3 if share < 0.33 else 2)


def _gathered(boxes: DataFrame) -> Column:
    return F.array_sort(F.collect_list(F.struct("box_id", "x1", "y1", "x2", "y2", F.col("score").cast("double").alias("score"))))


def without_duplicates(boxes: DataFrame) -> DataFrame:
    """page_id, box_id of the boxes that ``deduped`` keeps on each page, in order of their ids."""
    pages = boxes.groupBy("page_id").agg(_gathered(boxes).alias("b"))
    return pages.select("page_id", F.explode(K.batches(deduped_pages, "array<bigint>", F.col("b"))).alias("box_id"))


def with_columns(boxes: DataFrame, dominant: Column) -> DataFrame:
    """page_id, box_id, column of each box; ``dominant`` says which boxes decide."""
    item = F.struct("box_id", "x1", "y1", "x2", "y2", F.col("score").cast("double").alias("score"))
    pages = boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(item)).alias("b"), F.array_sort(F.collect_list(F.when(dominant, item))).alias("d"))
    found = pages.withColumn("c", K.column(columns, "array<int>", F.col("b"), F.col("d")))
    return found.select("page_id", F.explode(F.arrays_zip("b", "c")).alias("z")).select("page_id", F.col("z.b.box_id").alias("box_id"), F.col("z.c").alias("column"))


def matched_one_to_one(truth: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """page_id, truth_id, found_id by ``greedy_matches`` on each page, boxes in order of their ids."""
    a = truth.groupBy("page_id").agg(_gathered(truth).alias("t"))
    b = found.groupBy("page_id").agg(_gathered(found).alias("f"))
    pairs = K.batches(lambda t, f: matched_pages(t, f, least), "array<struct<truth_id:bigint,found_id:bigint>>", F.col("t"), F.col("f"))
    return a.join(b, "page_id").select("page_id", F.explode(pairs).alias("p")).select("page_id", "p.truth_id", "p.found_id")


def mapped_cells(truth: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """page_id, truth_id, found_id: each true cell and the first found cell that it overlaps by ``least``; not one to one."""
    return cells_by_threshold(truth, found, (least,)).select("page_id", "truth_id", F.element_at("firsts", 1).alias("found_id"))


def cells_by_threshold(truth: DataFrame, found: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """page_id, truth_id, firsts: for each true cell the first found cell that it overlaps by each threshold, null if none; one join for all of them."""
    t, f = truth.alias("t"), found.alias("f")
    a, b = G.box("t"), G.box("f")
    near = t.join(f, (F.col("t.page_id") == F.col("f.page_id")) & (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3]))
    pairs = near.select(F.col("t.page_id").alias("page_id"), F.col("t.box_id").alias("truth_id"), F.col("f.box_id").alias("found_id"), G.iou(a, b).alias("iou")).where(F.col("iou") >= min(thresholds))
    return pairs.groupBy("page_id", "truth_id").agg(F.array(*[F.min(F.when(F.col("iou") >= least, F.col("found_id"))) for least in thresholds]).alias("firsts"))


def adjacency_hits(truth: DataFrame, found: DataFrame, mapping: DataFrame) -> DataFrame:
    """page_id, tp, predicted, truth: neighbour relations (doc, source, target, direction), true ones mapped to found cells."""
    ends = mapping.select(F.col("page_id").alias("doc"), F.col("truth_id"), F.col("found_id"))
    mapped = truth.join(ends.select("doc", F.col("truth_id").alias("source"), F.col("found_id").alias("from")), ["doc", "source"])
    mapped = mapped.join(ends.select("doc", F.col("truth_id").alias("target"), F.col("found_id").alias("to")), ["doc", "target"]).select("doc", F.col("from").alias("source"), F.col("to").alias("target"), "direction").distinct()
    right = found.join(mapped, ["doc", "source", "target", "direction"], "left_semi").groupBy("doc").agg(F.count("*").alias("tp"))
    made = found.groupBy("doc").agg(F.count("*").alias("predicted"))
    real = truth.groupBy("doc").agg(F.count("*").alias("truth"))
    return real.join(made, "doc", "full").join(right, "doc", "left").select(F.col("doc").alias("page_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tp", "predicted", "truth")])


def table_scores(counts: DataFrame) -> DataFrame:
    """threshold, precision, recall, f1 from rows (threshold, tp, predicted, truth); the row without threshold is the weighted f1.

    Where nothing divides the weighted score is 0.
    """
    sums = counts.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "truth")])
    p, r = M.share(F.col("tp"), F.col("predicted")), M.share(F.col("tp"), F.col("truth"))
    each = sums.select("threshold", p.alias("precision"), r.alias("recall"), M.share(2 * p * r, p + r).alias("f1"))
    whole = each.agg(F.when(F.min("f1") > 0, F.sum(F.col("threshold") * F.col("f1")) / F.sum("threshold")).otherwise(0.0).alias("f1"))
    return each.unionByName(whole.select(F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), "f1"))


def group_of(label: Column) -> Column:
    """Reading group of a label; unknown ones are others."""
    return F.coalesce(*[F.when(label.isin(names), F.lit(g)) for g, names in GROUPS.items()], F.lit("others"))


def part_of(label: Column) -> Column:
    """Head, body or foot of the page; unknown labels are others."""
    return F.when(label.isin(HEAD), "head").when(label.isin(BODY), "body").when(label.isin(FOOT), "foot").otherwise("others")


def grouped_reading_order(boxes: DataFrame) -> DataFrame:
    """page_id, box_id, group, place of each box in its group; subtitles and footnotes stand in groups of their own too."""
    also = F.filter(F.array(*[F.when(F.col("label") == x, F.lit(g)) for x, g in ALSO.items()]), lambda g: g.isNotNull())
    listed = boxes.withColumn("group", F.explode(F.array_union(F.array(group_of(F.col("label"))), also)))
    return _placed(listed, "group")


def page_parts(boxes: DataFrame) -> DataFrame:
    """page_id, box_id, part, place of each box in its part of the page."""
    return _placed(boxes.withColumn("part", part_of(F.col("label"))), "part")


def _placed(boxes: DataFrame, by: str) -> DataFrame:
    from .layout import COLUMN_WEIGHT

    order = F.col("column") * COLUMN_WEIGHT + F.floor("y1")
    w = Window.partitionBy("page_id", by).orderBy(order, "box_id")
    return boxes.select("page_id", "box_id", by, (F.row_number().over(w) - 1).alias("place"))


def polygon_overlap(a: list[float] | None, b: list[float] | None) -> float | None:
    """Intersection over union of two convex polygons, as lists of x, y; integer coordinates, 0 without area.

    Sutherland-Hodgman clipping and the shoelace sum.
    """
    if a is None or b is None:
        return None
    p, q = ([(int(s[k]), int(s[k + 1])) for k in range(0, len(s) - 1, 2)] for s in (a, b))
    area = lambda s: sum(x * v - u * y for (x, y), (u, v) in zip(s, s[1:] + s[:1], strict=True)) / 2
    p, q = (s if area(s) >= 0 else s[::-1] for s in (p, q))
    cut = list(p)
    for (ax, ay), (bx, by) in zip(q, q[1:] + q[:1], strict=True):
        side = lambda s: (bx - ax) * (s[1] - ay) - (by - ay) * (s[0] - ax)  # noqa: B023, E731
        kept = []
        for s, t in zip(cut, cut[1:] + cut[:1], strict=True):
            u, v = side(s), side(t)
            if u >= 0:
                kept.append(s)
            if (u > 0 > v) or (u < 0 < v):
                w = u / (u - v)
                kept.append((s[0] + w * (t[0] - s[0]), s[1] + w * (t[1] - s[1])))
        cut = kept
    both = abs(area(cut)) if len(cut) > 2 else 0.0
    union = area(p) + area(q) - both
    return both / union if union > 0 else 0.0


#: Pieces that a crop is cut into, by its height over the tallest one's; later limits rule out the first.
PIECES = [(0.8, 16), (0.6, 12), (0.4, 9), (0.3, 7), (0.2, 5), (0.12, 3), (0.08, 2)]


def piece_count(height: Column, tallest: Column, label: Column) -> Column:
    """How many pieces a crop is cut into; formulas stay whole."""
    found = F.coalesce(*[F.when(height > least * tallest, n) for least, n in PIECES], F.lit(1))
    return F.when(label == "formula", 1).otherwise(found)


def merged_dots(boxes: list | None) -> list[tuple] | None:
    """Letter boxes (x, y, w, h) from left to right; a box within the width of the one before is its dot and joins it."""
    if boxes is None:
        return None
    out: list[tuple] = []
    for x, y, w, h in boxes:
        if out and x >= out[-1][0] and x + w <= out[-1][0] + out[-1][2]:
            px, py, pw, ph = out[-1]
            top = min(y, py)
            out[-1] = (px, top, pw, max(y + h, py + ph) - top)
        else:
            out.append((x, y, w, h))
    return out
