"""Aggregates over scores: micro precision and recall, impurity, running variance, robust class limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import metrics as M


def micro_prf(counts: DataFrame, by: list[str]) -> DataFrame:
    """Micro precision, recall and F1 from sums of ``tp``, ``predicted``, ``truth``; zeros where nothing divides, null where there is nothing at all."""
    sums = counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "truth")])
    p, r = M.share(F.col("tp"), F.col("predicted")), M.share(F.col("tp"), F.col("truth"))
    some = (F.col("predicted") > 0) | (F.col("truth") > 0)
    return sums.select(*by, *[F.when(some, F.round(c, 6)).alias(n) for n, c in (("precision", p), ("recall", r), ("f1", M.share(2 * p * r, p + r)))])


def multiset_hits(predicted: DataFrame, truth: DataFrame, by: list[str], item: str) -> DataFrame:
    """by, tp, predicted, truth: items counted as multisets, hits as the least of both counts.  Per group, pre-aggregated."""
    a = predicted.groupBy(*by, item).agg(F.count("*").alias("p"))
    b = truth.groupBy(*by, item).agg(F.count("*").alias("t"))
    both = a.join(b, [*by, item], "full").na.fill(0, ["p", "t"])
    return both.groupBy(*by).agg(F.sum(F.least("p", "t")).alias("tp"), F.sum("p").alias("predicted"), F.sum("t").alias("truth"))


def impurity(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """by, n, gini: n - sum(count^2) / n over label counts."""
    counts = rows.groupBy(*by, label).agg(F.count("*").alias("c"))
    return counts.groupBy(*by).agg(F.sum("c").alias("n"), F.round(F.sum("c") - F.sum(F.col("c") * F.col("c")) / F.sum("c"), 6).alias("gini"))


def window_variance(scores: DataFrame, by: str, pos: str, score: str, size: int = 15) -> DataFrame:
    """``spread``: population variance / size of each full window that starts at a row; the last full one is left out."""
    w = Window.partitionBy(by).orderBy(pos)
    n = F.count("*").over(Window.partitionBy(by))
    out = scores.withColumn("spread", F.var_pop(score).over(w.rowsBetween(0, size - 1)) / size)
    return out.withColumn("__n", n).withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= F.col("__n") - size).drop("__n", "__k")


def suffix_variance(rows: DataFrame, by: str, pos: str, value: str, name: str) -> DataFrame:
    """``name``: population variance of the value from each row to the end."""
    return rows.withColumn(name, F.var_pop(value).over(Window.partitionBy(by).orderBy(pos).rowsBetween(0, Window.unboundedFollowing)))


def median_limits(rows: DataFrame, by: str, value: Column, factor: float = 5.0) -> DataFrame:
    """by, median, low, high: the median and the limits ``factor`` median deviations off."""
    valued = rows.select(by, value.alias("v"))
    medians = valued.groupBy(by).agg(F.percentile("v", F.lit(0.5)).alias("median"))
    spread = valued.join(medians, by).groupBy(by, "median").agg(F.percentile(F.abs(F.col("v") - F.col("median")), F.lit(0.5)).alias("mad"))
    return spread.select(by, F.round("median", 6).alias("median"), F.round(F.col("median") - factor * F.col("mad"), 6).alias("low"), F.round(F.col("median") + factor * F.col("mad"), 6).alias("high"))


def binary_impurity(rows: DataFrame, by: list[str], positive: Column) -> DataFrame:
    """by, n, gini: n - positives^2 / n."""
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(positive).alias("hits"))
    return counts.select(*by, "n", F.round(F.col("n") - F.col("hits") * F.col("hits") / F.col("n"), 6).alias("gini"))


def interval_impurity(rows: DataFrame, value: str, label: str, edges: list[float]) -> DataFrame:
    """class, gini, step for intervals (edges[c], edges[c + 1]]: binary impurity of label c, and the sum with the next interval's.

    An interval without rows has impurity 0; the last one has no step.
    """
    inside = F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(value))
    held = rows.withColumn("class", F.size(inside) - 1).where((F.col("class") >= 0) & (F.col("class") < len(edges) - 1) & (F.col(value) <= edges[-1]))
    found = binary_impurity(held, ["class"], F.col(label) == F.col("class")).select("class", "gini")
    every = rows.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("class")).join(found, "class", "left")
    gini = F.coalesce("gini", F.lit(0.0))
    return every.select("class", gini.alias("gini"), (gini + F.lead(gini).over(Window.orderBy("class"))).alias("step"))  # a row per class


def reduced(impurities: DataFrame, how: str) -> DataFrame:
    """Interval impurities as they are (none), or their sum or mean."""
    if how == "none":
        return impurities
    return impurities.agg(({"sum": F.sum, "mean": F.avg}[how])("gini").alias("gini"))


def filled_forward(rows: DataFrame, order: str, value: str) -> DataFrame:
    """``value`` of classes without one from the class before, 0 in front of all; one row per class."""
    before = F.last(value, ignorenulls=True).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(value, F.coalesce(before, F.lit(0.0)))
