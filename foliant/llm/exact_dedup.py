"""Exact dedup over a cuckoo-filter index of text digests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cuckoo import CuckooIndex
from .slices import release
from .storage import shuffle_width, stored, temporary

#: Live entries of a map-side index before it is drained downstream.
LOCAL_ENTRIES = 100_000
#: Digests of one index behind the shuffle.
INDEX_ENTRIES = 500_000
#: A group's rows are dealt over so many tasks when its keeper is joined back.
SALTS = 32
#: Keys of rows that go up to which they are broadcast; more of them are joined by a shuffle.
BROADCAST_KEYS = 500_000

_PARTIAL = "digest binary, keep_id long, keep_uid long, n long"


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _index(limit: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = CuckooIndex()

        def out() -> pd.DataFrame:
            held = index.drain()
            return pd.DataFrame({"digest": [e[0] for e in held], "keep_id": pd.array([e[1][1] for e in held], dtype="Int64"), "keep_uid": [e[1][2] for e in held], "n": [e[2] for e in held]})

        for batch in batches:
            for digest, some_id, uid, n in zip(batch["digest"], batch["keep_id"], batch["keep_uid"], batch["n"], strict=True):
                digest = bytes(digest)
                # a null id comes after all others
                first = (True, None, uid) if pd.isna(some_id) else (False, int(some_id), uid)
                old = index.delete(digest)
                if old is not None:
                    first, n = min(first, old[1], key=lambda f: (f[0], f[1] or 0, f[2])), n + old[2]
                index.insert([digest, first, n])
            if limit and len(index) > limit:
                yield out()
        yield out()
        release()

    return run


def groups(digests: DataFrame, rows: int) -> DataFrame:
    """digest, keep_id, keep_uid, n from ``rows`` rows (doc_id, uid, digest).

    Every scan task collapses its copies in an index of its own before the
    shuffle, so a text that is a third of all rows sends one row per task.
    """
    single = digests.select("digest", F.col("doc_id").alias("keep_id"), F.col("uid").alias("keep_uid"), F.lit(1).cast("long").alias("n"))
    local = single.mapInPandas(_index(LOCAL_ENTRIES), _PARTIAL)
    width = max(shuffle_width(digests.sparkSession), rows // INDEX_ENTRIES)
    return local.repartition(width, "digest").mapInPandas(_index(None), _PARTIAL)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the smallest id of a group stays.  A null id counts as larger
    than any other.  Of rows that repeat id and text exactly one stays.  Null
    and empty texts are equal to each other; white-space-only texts all become
    a single space and are equal to each other, not to the empty text.
    """
    with temporary(docs.sparkSession) as lasting:
        digests = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"))
        digests = stored(digests.withColumn("uid", F.monotonically_increasing_id()), "digests")
        several = groups(digests, digests.count()).where("n > 1")
        keepers = several.select("digest", "keep_id", "keep_uid", "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = digests.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
        rows = salted.join(keepers, ["digest", "salt"], "left").select(
            "doc_id",
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            (F.col("n").isNull() | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        return lasting(rows, "exact")


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Ids that repeat under different texts are told apart by the digest.  Only
    keys of rows that go are brought to the texts, which are not shuffled while
    those keys are few; rows that repeat id and text meet by their key.
    """
    names = docs.columns
    key = lambda id_, sha: F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), sha)
    out = exact_dedup(docs, id_col, text_col).where("NOT kept")
    gone = stored(out.select(key(F.col("doc_id"), F.col("text_sha256")).alias("__key"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("__again")).distinct(), "gone")
    few = gone.count() <= BROADCAST_KEYS
    held = lambda rows: F.broadcast(rows) if few else rows
    keyed = docs.withColumn("__key", key(F.col(id_col).cast("long"), F.sha2(normalised(F.col(text_col)), 256)))
    plain = keyed.join(held(gone.select("__key")), "__key", "left_anti")
    repeated = keyed.join(held(gone.where("__again").select("__key")), "__key", "left_semi").dropDuplicates(["__key"])
    return plain.unionByName(repeated).select(*names)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
), g AS (
  SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256 FROM d JOIN g USING (h)
"""
