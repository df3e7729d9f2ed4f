"""Queries and SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, media, minhash, packing, pii, quality, sharding, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": minhash.op1_minhash,
    "op2_url_filters": url_filters.op2_url_filters,
    "op3_quality": quality.op3_quality,
    "op4_bpe": bpe.op4_bpe,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_packing": packing.op6_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_media": media.op8_media,
    "op9_pii": pii.op9_pii,
    "op10_sharding": sharding.op10_sharding,
}
ORACLES: dict[str, str] = {
    "op1_minhash": minhash.SQL,
    "op2_url_filters": url_filters.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
}
