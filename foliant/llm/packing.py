"""Best-fit packing with bounds that certify each partition's bin count."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .storage import discard, stored, temporary

CAPACITY = 2048
#: Pieces of one packing group, and rounds of exchange between groups with gaps: at most 5, three bits of an id.
#: They bear on how few sequences there are, not on which pieces are packed.
GROUP_PIECES, ROUNDS = 8192, 4


def best_fit_decreasing(lengths: Sequence[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; longest first into the fullest bin that has room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, made = 0, 0
    for i in order:
        n = lengths[i]
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - room
        left = room - n
        if left:
            by_room[left].append(b)
            open_rooms |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of bins by dual feasible functions.

    The thresholds f_t (x above capacity - t counts whole, below t counts
    nothing) for every t, and the roundings u_k for k up to 16.
    """
    counts = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    best = 0
    mass, above = np.cumsum(counts * sizes), np.cumsum(counts[::-1])[::-1]
    for t in range(0, capacity // 2 + 1):
        whole = int(above[capacity - t + 1]) if t else 0
        middle = int(mass[capacity - t] - (mass[t - 1] if t else 0))
        best = max(best, whole + -(-middle // capacity))
    for k in range(1, 17):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        # in units of 1 / (k * capacity), so that all stays in integers
        value = np.where(exact, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    lengths = frame["length"].to_numpy()
    bins, offsets = best_fit_decreasing(lengths.tolist())
    bins = np.asarray(bins, dtype=np.int64)
    fill = np.bincount(bins, weights=lengths) if len(bins) else np.zeros(0)
    bound = lower_bound(lengths)
    return pd.DataFrame(
        {
            "uid": frame["uid"].to_numpy(),
            "length": lengths,
            "grp": frame["grp"].to_numpy(),
            "bin": bins,
            "offset": np.asarray(offsets, dtype=np.int64),
            # a certified group is closed; the others give up the bins that have gaps
            "open": (fill < CAPACITY)[bins] & (len(fill) > bound),
        }
    )


_PACKED = "uid long, length long, grp long, bin long, offset long, open boolean"


def _round(pieces: DataFrame, count: int, seed: int) -> DataFrame:
    groups = max(1, -(-count // GROUP_PIECES))
    dealt = pieces.select("uid", "length").withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)))
    return stored(dealt.groupBy("grp").applyInPandas(_pack, _PACKED), "packed")


def _bins(packed: DataFrame, where: str = "true") -> tuple[int, int]:
    """Bins and pieces; each group sends its distinct bins only."""
    r = packed.where(where).agg(F.count_if(F.col("offset") == 0), F.count("*")).first()
    return r[0], r[1]


def pack(pieces: DataFrame) -> DataFrame:
    """sequence_id and offset for rows (uid, length), uid unique, 1 <= length <= CAPACITY.

    Pieces that fill a sequence take one each.  The others are dealt into
    groups of about ``GROUP_PIECES``; each is packed best-fit decreasing and
    compared with its lower bound.  Groups that do not meet it hand the pieces
    of their unfilled sequences to an exchange, which deals them into new
    groups and packs again; an exchange is accepted if it saves a sequence.
    """
    full = pieces.where(F.col("length") == CAPACITY).select("uid", (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < CAPACITY)
    # one bit apart from full pieces, 16 for the bin, 3 for the round, and the rest, 43, for the group
    number = lambda df, k: df.select("uid", (((F.col("grp") * 8 + k) * (1 << 16) + F.col("bin")) * 2).alias("sequence_id"), "offset")
    packed = _round(part, part.count(), 0)
    done, k = full.unionByName(number(packed.where("not open"), 0)), 0
    open_bins, open_pieces = _bins(packed, "open")
    left = packed.where("open")
    for k in range(1, ROUNDS + 1):
        if open_pieces == 0:
            break
        again = _round(left, open_pieces, k)
        bins, _ = _bins(again)
        if bins >= open_bins:
            discard(again)
            break
        done = done.unionByName(number(again.where("not open"), k))
        left, packed = again.where("open"), again
        open_bins, open_pieces = _bins(again, "open")
    else:
        k += 1
    return done.unionByName(number(left, max(0, k - 1)))


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", cache_bytes: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece.

    A document is its ids and id 0; only documents above ``CAPACITY`` tokens
    are cut.  Null and empty texts are the single id 0.  Repeated rows are
    packed as rows of their own; null ids stay null.  ``cache_bytes`` bounds the
    word cache of a worker and bears on time only.
    """
    with temporary(docs.sparkSession) as lasting:
        pieces = bpe.piece_table(docs, path or bpe.vocabulary_path(), CAPACITY, 0, id_col, text_col, cache_bytes)
        held = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
        placed = pack(held.select("uid", "length"))
        return lasting(held.join(placed, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"), "sequences")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
