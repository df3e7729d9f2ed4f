"""Pages that arrive one by one become documents; runs of lines become sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PAGES = "doc_id bigint, page int, n_pages int, text string, at timestamp"
DOCUMENTS = "doc_id bigint, n_pages int, complete boolean, document string"


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages from JSON lines files as they arrive."""
    return spark.readStream.schema(PAGES).json(folder)


def _document(doc_id: int, pages: dict[int, str], complete: bool) -> pd.DataFrame:
    text = "".join(pages[k] for k in sorted(pages)).strip()
    while "\n\n\n" in text:
        text = text.replace("\n\n\n", "\n\n")
    return pd.DataFrame({"doc_id": [doc_id], "n_pages": [len(pages)], "complete": [complete], "document": [text]})


def documents(pages: DataFrame, late: int = 600) -> DataFrame:
    """One row a document, once all its pages are there, or incomplete once none has come for ``late`` seconds.

    A page that comes twice counts once, the first time; a page that comes after
    its document is done starts a new one.  State holds the pages of open
    documents only.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        numbers, texts, total = state.get if state.exists else ([], [], 0)
        held = dict(zip(numbers, texts, strict=True))
        if state.hasTimedOut:
            state.remove()
            yield _document(key[0], held, False)
            return
        newest = 0
        for batch in batches:
            for page, n, text, at in zip(batch["page"], batch["n_pages"], batch["text"], batch["at"], strict=True):
                held.setdefault(int(page), text or "")
                total, newest = max(total, int(n)), max(newest, int(at.timestamp() * 1000))
        if len(held) >= total:
            if state.exists:
                state.remove()
            yield _document(key[0], held, True)
        else:
            state.update((list(held), list(held.values()), total))
            state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + late * 1000)

    return (
        pages.withWatermark("at", f"{late} seconds")
        .groupBy("doc_id")
        .applyInPandasWithState(run, DOCUMENTS, "pages array<int>, texts array<string>, total int", "append", GroupStateTimeout.EventTimeTimeout)
    )


def sessions(events: DataFrame, key: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """key, start, end, n: runs of events (key, at) that no ``gap`` parts; the streaming form of islands."""
    runs = events.withWatermark("at", late).groupBy(key, F.session_window("at", gap).alias("w")).agg(F.count("*").alias("n"))
    return runs.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
