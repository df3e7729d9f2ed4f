"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Only for a single machine that names no shared folder.
LOCAL_FALLBACK = "/tmp/checkpoints"

#: Rows of an Arrow batch while a table is stored.
BATCH_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; a folder of our own where all tasks run on this machine.

    A cluster that names none is an error: what one executor wrote to its own
    disk no other could read.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not named:
        master = conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = LOCAL_FALLBACK
    return named.rstrip("/")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Arrow batches of BATCH_ROWS inside: whole texts of ten thousand rows would stand on both sides of a worker's pipe."""
    return _setting(spark, _BATCH, str(BATCH_ROWS))


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a query inside go when it ends, not when the driver next collects garbage."""
    return _setting(spark, _CLEANUP, "true")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Every later job reads the files, so a lost executor costs no recomputation
    and values that depend on task order (row numbers) stay fixed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/foliant-{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` made and nothing reads any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/foliant-" in name:
            _delete(df.sparkSession, name)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at the end, but for those stored by the function that this yields.

    Those last as long as an enclosing block of this kind, if there is one.
    """
    made: list[str] = []
    outer = _made.get()
    token = _made.set(made)

    def lasting(df: DataFrame, label: str) -> DataFrame:
        out = stored(df, label)
        path = made.pop()
        if outer is not None:
            outer.append(path)
        return out

    try:
        yield lasting
    finally:
        _made.reset(token)
        for name in made:
            _delete(spark, name)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
