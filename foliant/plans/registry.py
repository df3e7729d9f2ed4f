"""Queries and SQL of the engine's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import corpus, evaluation, layout, lines, papers, texts

_PLANS = (evaluation, lines, corpus, papers, layout, texts)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for plan in _PLANS for k, v in plan.QUERIES.items()}
ORACLES: dict[str, str] = {k: v for plan in _PLANS for k, v in plan.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of HTML as markup, split into the pages of their printed text."""
    return texts.split_pages(spark, sf_dir)
