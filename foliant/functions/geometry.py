"""Boxes (x1, y1, x2, y2) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(alias: str) -> Box:
    return F.col(f"{alias}.x1"), F.col(f"{alias}.y1"), F.col(f"{alias}.x2"), F.col(f"{alias}.y2")


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def overlap(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def iou(a: Box, b: Box) -> Column:
    both = overlap(a, b)
    return both / (area(a) + area(b) - both)


def points_to_pixels(p: Column, dpi: int = 96) -> Column:
    """Half-even rounding of points at ``dpi``."""
    return F.bround(p * dpi / 72).cast("long")


def padded(b: Box, share: float = 0.005) -> Box:
    """Grown on all sides by a share of the shorter side, rounded."""
    pad = F.least(b[2] - b[0], b[3] - b[1]) * share
    return F.bround(b[0] - pad), F.bround(b[1] - pad), F.bround(b[2] + pad), F.bround(b[3] + pad)


def normalised(b: Box, width: Column, height: Column) -> Box:
    """Shares of the page to four places, y pointing up."""
    return F.round(b[0] / width, 4), F.round(1 - b[3] / height, 4), F.round(b[2] / width, 4), F.round(1 - b[1] / height, 4)


def _short(c: Column) -> Column:
    """A share to four places, trailing zeros but one left out."""
    return F.regexp_replace(F.format_string("%.4f", c), r"(\.[0-9]+?)0+\z", "$1")


def figure_markup(title: Column, box_: Box, caption: Box, width: Column, height: Column) -> Column:
    """A figure's content with its page-relative coordinates: in front of the title if the caption's middle lies below the figure's, else behind it."""
    names = ("x1", "y1", "x2", "y2")
    shares = [F.concat(F.lit(f"{n}="), _short(c)) for n, c in zip(names, normalised(box_, width, height), strict=True)]
    coords = F.concat(F.lit("[FIGURE_COORDS]("), F.concat_ws(", ", *shares), F.lit(")[END_FIGURE_COORDS]"))
    below = caption[1] + caption[3] > box_[1] + box_[3]
    return F.concat(F.when(below, F.concat_ws("\n", coords, title)).otherwise(F.concat_ws("\n", title, coords)), F.lit("\n"))
