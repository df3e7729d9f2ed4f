"""Arrow batches handed to Python in small slices, and word caches that one operator holds at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that are Python objects at once; whole batches stay in Arrow's own memory.
ROWS = 256
#: Entries of each word cache of a worker.
CACHE_ENTRIES = 100_000

_held: dict[str, list[dict]] = {}


def hold(owner: str, *caches: dict) -> None:
    """Note the caches of ``owner`` and empty those of every other operator in this worker."""
    for other, old in list(_held.items()):
        if other != owner:
            for cache in old:
                cache.clear()
            del _held[other]
    _held[owner] = list(caches)


def release() -> None:
    """Give memory that this worker does not use back to the system; idle workers stay alive beside the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not on this system
        pass


def map_slices(df: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` over slices of ``ROWS`` rows; integers with nulls arrive as objects."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(names)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    out = run(batch.slice(at, ROWS).to_pandas(integer_object_nulls=True))
                    if len(out):
                        yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)
        finally:
            release()

    return df.mapInArrow(go, schema)
