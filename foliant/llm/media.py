"""GIF columns: decoded, timed frames with colour histograms."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gif
from .slices import map_slices

UNIT = 64
_FRAMES = "media_id long, frame int, start_cs long, delay_cs long, width int, height int, disposal int, pixels binary, histogram array<long>, error string"


def gif_frames(media: DataFrame, id_col: str = "media_id", bytes_col: str = "content") -> DataFrame:
    """One row per frame: media_id, frame, start_cs, delay_cs, width, height, disposal, pixels, histogram, error.

    ``pixels`` is the RGBA canvas once the frame is drawn.  A null, empty or
    broken file gives one row with frame -1 and the reason in ``error``; so does a
    file without frames and one whose screen or a frame of which is above
    ``gif.MAX_PIXELS``.  Repeated rows are decoded as rows of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in _FRAMES.split(", ")]
        for batch in batches:
            for some_id, content in zip(batch["media_id"].astype("Int64"), batch["content"], strict=True):
                clock, error = 0, None
                one = lambda *row: pd.DataFrame([row], columns=names).astype({"media_id": "Int64"})
                try:
                    w, h, frames = gif.parse(bytes(content or b""))
                    error = None if frames else "no frames"
                except ValueError as e:
                    frames, error = [], str(e)
                if error:
                    yield one(some_id, -1, 0, 0, 0, 0, 0, b"", np.zeros(64, dtype=np.int64), error)
                # a frame at a time, so that a long animation holds one canvas
                for k, (f, canvas) in enumerate(zip(frames, gif.render(w, h, frames) if frames else (), strict=True)):
                    yield one(some_id, k, clock, f.delay, w, h, f.disposal, canvas.tobytes(), gif.colour_histogram(canvas), None)
                    clock += f.delay

    return media.select(F.col(id_col).cast("long").alias("media_id"), F.col(bytes_col).alias("content")).mapInPandas(run, _FRAMES)


def _row(text: str | None) -> tuple:
    raw = (text or "").encode()
    payload = raw + b"\0" * (-len(raw) % UNIT if raw else UNIT)
    stored = gif.store_samples(payload)
    width, height, frames = gif.parse(stored)
    back = b"".join(f.samples for f in frames)
    colours = np.zeros(64, dtype=np.int64)
    for canvas in gif.render(width, height, frames):
        colours += gif.colour_histogram(canvas)
    cells = ",".join(f"{i}:{n}" for i, n in enumerate(colours.tolist()) if n)
    feature = f"frames={len(frames)};size={width}x{height};cs={sum(f.delay for f in frames)};colours={cells}"
    return len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), feature


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as a GIF, read it back and compute features; digest columns only.

    Null and empty texts are 64 zero bytes.  Null ids stay null; repeated rows
    are rows of their own.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        out = pd.DataFrame([_row(t) for t in batch["text"]], columns=names)
        out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
        return out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(rows, run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
