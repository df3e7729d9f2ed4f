"""A bounded sample of labelled rows for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text, mod ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, bound: int) -> tuple[list[tuple[str, int]], float]:
    """About ``bound`` (text, label) rows of each label, whole texts, chosen by a hash of the id; the share of label 1.

    ``allowed`` says which rows may be learnt from.  Only the sample reaches the
    driver, and its ids, about twice ``bound``, are broadcast so that no text is shuffled; rows without a label, id or text are not learnt from, and ids that
    carry several labels count with the smallest.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("label")).where(allowed)
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("label") == value, F.lit(bound / n)).otherwise(share)
    picked = known.where(draw < share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id").select("text", "label").collect()
    return sorted({(r["text"], r["label"]) for r in rows}), sizes.get(1, 0) / max(1, sum(sizes.values()))
