"""Range sharding by sampled, size-weighted splitters.  DataFrame functions only."""

from __future__ import annotations

import heapq
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import shuffle_width, stored, temporary

#: Bytes that a record costs besides its text.
RECORD_BYTES = 16
#: A group above this share of a shard is placed by itself; at most shards / LARGE_SHARE such groups exist.
LARGE_SHARE = 1 / 32
#: Sampled keys per range, and most ranges: together they bound what the driver holds.
OVERSAMPLE, MAX_RANGES = 24, 4096


def _levels(loads: list[int], rest: int) -> list[int]:
    """Room that each shard has for ``rest`` bytes so that totals come out level."""
    order = sorted(loads)
    below, level = 0, 0.0
    for k, load in enumerate(order, 1):
        below += load
        level = (below + rest) / k
        if k == len(order) or level <= order[k]:
            break
    return [max(0, round(level - x)) for x in loads]


def _deal_large(units: list[tuple[int, int]], shards: int) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """(shard, first slot) of each large unit (bytes, rows), in order to the lightest shard; loads; counts of rows."""
    heap = [(0, s) for s in range(shards)]
    counts, loads, out = [0] * shards, [0] * shards, []
    for size, n in units:
        load, s = heapq.heappop(heap)
        out.append((s, counts[s]))
        counts[s] += n
        loads[s] = load + size
        heapq.heappush(heap, (loads[s], s))
    return out, loads, counts


def _boundaries(sample: list[tuple], ranges: int) -> list[tuple]:
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)} if sample else set())


def _ranged(rows: DataFrame, splitters: list[tuple], order: list[Column]) -> DataFrame:
    """``part``: how many splitters lie at or below a row's order columns, the first of which is a hash.

    A row finds its few splitters through the cell of its hash's leading bits.
    """
    spark = rows.sparkSession
    cells = max(1, 1 << (len(splitters).bit_length()))
    shift = 64 - (cells.bit_length() - 1)
    lows = [(c << shift) - (1 << 63) for c in range(cells)]
    at = [bisect_left(splitters, (low,)) for low in lows] + [len(splitters)]
    lookup = spark.createDataFrame([(c, at[c], [list(s) for s in splitters[at[c] : at[c + 1]]]) for c in range(cells)], "cell int, first int, marks array<array<bigint>>")
    cell = (F.shiftright(order[0], shift) + cells // 2).cast("int") if shift < 64 else F.lit(0)
    own = F.array(*order)
    held = rows.withColumn("cell", cell).join(F.broadcast(lookup), "cell")
    return held.withColumn("part", F.col("first") + F.size(F.filter("marks", lambda m: m <= own))).drop("cell", "first", "marks")


_GROUP = ["key", "size", "text_crc32"]


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``bytes``: sizes of shards are level.  Equal texts are one group and stay
    in one shard; a group above a shard's share is cut into parts of
    ``LARGE_SHARE`` of a share.  Groups and parts above that are dealt first, the
    largest to the lightest shard.  For the rest a sample weighted by size gives
    quantile boundaries over the text hash, each range gets its exact byte count,
    and the running position of a group's middle says which shard's room it falls
    into, which subdivides every range that holds more than one shard's share.
    No shard's size is then off the mean by more than about the largest group
    that it holds, and no more than ``LARGE_SHARE`` where groups are small.
    Rows of one group are numbered in ranges over (hash, id, row), so a group of
    any size is many tasks.  Null texts have no bytes and are a group with the
    empty texts; repeated rows are rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + RECORD_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )
    with temporary(spark) as lasting:
        base = stored(base.withColumn("uid", F.monotonically_increasing_id()), "sizes")
        groups = stored(base.groupBy(*_GROUP).agg(F.count("*").alias("n")).withColumn("bytes", F.col("n") * F.col("size")), "groups")
        total, rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        share = total / shards
        cut = share * LARGE_SHARE
        per = F.when(F.col("bytes") > share, F.greatest(F.lit(1), F.floor(F.lit(cut) / F.col("size")))).otherwise(F.col("n")).cast("long")
        units = groups.withColumn("per", per).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.col("per")))))
        units = units.withColumn("n", F.least("per", F.col("n") - F.col("chunk") * F.col("per"))).withColumn("bytes", F.col("n") * F.col("size"))

        # the few large units, largest first
        large = units.where(F.col("bytes") > cut).select(*_GROUP, "per", "chunk", "n", "bytes").collect()
        large.sort(key=lambda u: (-u["bytes"], *u[:5]))
        dealt, loads, counts = _deal_large([(u["bytes"], u["n"]) for u in large], shards)
        small = units.where(F.col("bytes") <= cut)
        room = _levels(loads, total - sum(loads))
        ends = [sum(room[: k + 1]) for k in range(shards)]

        # a sample of rows weighted by size, and its quantiles
        ranges = max(1, min(MAX_RANGES, max(4 * shuffle_width(spark), rows // 200_000)))
        chance = F.col("size") * (float(ranges * OVERSAMPLE) / max(total, 1))
        draw = F.pmod(F.xxhash64("doc_id", "key", "uid", F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        order = [F.col("key"), F.coalesce("doc_id", F.lit(-(1 << 63))), F.col("uid")]
        sample = sorted(tuple(r) for r in base.where(draw < chance).select(*[c.alias(f"o{k}") for k, c in enumerate(order)]).collect())
        splitters = _boundaries(sample, ranges)

        # exact bytes and rows in front of each range of small units
        ranged = _ranged(small, sorted({s[:1] for s in splitters}), order[:1])
        offsets, bytes_ = [], 0
        for r in ranged.groupBy("part").agg(F.sum("bytes").alias("b")).orderBy("part").collect():
            offsets.append((r["part"], bytes_))
            bytes_ += r["b"]
        before = spark.createDataFrame(offsets, "part int, bytes_before long")
        inside = Window.partitionBy("part").orderBy(*_GROUP, "chunk")
        up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
        middle = F.col("bytes_before") + F.sum("bytes").over(up_to) - F.col("bytes") / 2
        shard = F.least(F.lit(shards - 1), F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("middle"))))
        placed = stored(ranged.join(F.broadcast(before), "part").withColumn("middle", middle).withColumn("shard", shard), "placed")
        # a shard's units lie in neighbouring ranges: rows in front are sums by range, then inside it
        fronts, at = [], list(counts)
        for r in placed.groupBy("part", "shard").agg(F.sum("n").alias("n")).orderBy("shard", "part").collect():
            fronts.append((r["part"], r["shard"], at[r["shard"]]))
            at[r["shard"]] += r["n"]
        front = spark.createDataFrame(fronts, "part int, shard int, front long")
        own = Window.partitionBy("part", "shard").orderBy(*_GROUP, "chunk").rowsBetween(Window.unboundedPreceding, 0)
        starts = placed.join(F.broadcast(front), ["part", "shard"]).select(*_GROUP, "chunk", "per", "shard", (F.col("front") + F.sum("n").over(own) - F.col("n")).alias("start"))
        big = spark.createDataFrame([(*u[:3], u["chunk"], u["per"], s, slot) for u, (s, slot) in zip(large, dealt, strict=True)], "key long, size long, text_crc32 long, chunk long, per long, shard int, start long")
        where = stored(starts.unionByName(big), "places")

        # each row's number in its group: rows of the same group in ranges before, then inside the range
        numbered = _ranged(base, splitters, order)
        split_keys = spark.createDataFrame([(k,) for k in sorted({s[0] for s in splitters})], "key long")
        seen: dict[tuple, int] = {}
        cuts = []
        for r in numbered.join(F.broadcast(split_keys), "key").groupBy(*_GROUP, "part").agg(F.count("*").alias("n")).orderBy(*_GROUP, "part").collect():
            group = (r["key"], r["size"], r["text_crc32"])
            cuts.append((*group, r["part"], seen.get(group, 0)))
            seen[group] = seen.get(group, 0) + r["n"]
        earlier = spark.createDataFrame(cuts, "key long, size long, text_crc32 long, part int, earlier long")
        here = F.row_number().over(Window.partitionBy(*_GROUP, "part").orderBy(*order[1:])) - 1
        numbered = numbered.withColumn("here", here).join(F.broadcast(earlier), [*_GROUP, "part"], "left")
        numbered = numbered.withColumn("idx", F.coalesce("earlier", F.lit(0)) + F.col("here")).select("doc_id", *_GROUP, "idx")
        pers = F.broadcast(where.where("chunk > 0").select(*_GROUP, "per").distinct())  # groups above a shard's share: fewer than shards
        rows_ = numbered.join(pers, _GROUP, "left").withColumn("chunk", F.coalesce(F.floor(F.col("idx") / F.col("per")), F.lit(0))).drop("per")
        out = rows_.join(where, [*_GROUP, "chunk"])
        slot = F.col("start") + F.col("idx") - F.col("chunk") * F.col("per")
        return lasting(out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard")), "shards")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
