"""Text metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts below so many characters are not measured.
LEAST = 4


def measured(a: Column, b: Column) -> Column:
    return (F.length(a) >= LEAST) & (F.length(b) >= LEAST)


def edit_distance_share(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; null where either text is too short."""
    return F.when(measured(a, b), F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def precision_recall(hypothesis: Column, reference: Column) -> tuple[Column, Column]:
    """Of two word arrays taken as sets; null where the set divided by is empty."""
    h, r = F.array_distinct(hypothesis), F.array_distinct(reference)
    both = F.size(F.array_intersect(h, r))
    return F.when(F.size(h) > 0, both / F.size(h)), F.when(F.size(r) > 0, both / F.size(r))


def f_measure(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def meteor(hypothesis: Column, reference: Column) -> Column:
    """NaN for measured texts, null for others: the metric needs a corpus of synonyms, and there is none."""
    return F.when(measured(hypothesis, reference), F.lit(float("nan")))
