"""Corpus pipeline: quality, exact dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``, extra ones and such with names that
stages use themselves included.  Null texts count as empty and stay null; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import exact_dedup, minhash, packing, pii, quality
from foliant.llm.storage import stored, temporary

#: Bytes of a worker's word cache in packing: workers stand beside heaps that the stages before have filled.
PACKING_CACHE_BYTES = 48 << 20


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, predicts 1; a score of exactly 0.5 is 1.

    Empty texts are judged by the bias alone.  Equal texts are judged alike, and
    rows that repeat stay or go together.  Without labels everything stays.
    """
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id; null ids come last.

    Of rows that repeat id and text one stays.  Null and empty texts are equal.
    """
    return exact_dedup.keep_first_copies(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five words, similarity 0.8 or more), the smallest doc_id.

    Texts without words and rows without an id stay; rows that repeat the one
    that stays, too.
    """
    return minhash.keep_one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing words replaced; n_chars follows the new text.

    No row goes, and a text without a base span stays as it is.
    """
    return pii.sanitised(docs, count_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens; an empty text is one end token.

    Every row is packed, repeated ones too; which of equally good places a piece
    takes is not defined.
    """
    return packing.pack_documents(docs, cache_bytes=PACKING_CACHE_BYTES)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", first_copies),
    ("near_dedup", one_of_each_group),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: SQL can express neither a trained classifier nor packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; only the last one's table remains."""
    with temporary(spark) as lasting:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        return lasting(STAGES[-1][1](spark, docs, sf_dir), "pipeline")
