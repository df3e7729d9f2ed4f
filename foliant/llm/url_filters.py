"""URL filters as a sort-merge range join.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import shuffle_width, stored, temporary

#: (host, path, verdict): a rule fits its host, all subdomains and every path that starts with its own.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Verdict where no rule fits.
DEFAULT = "allow"
#: Sampled keys per splitter, and most splitters, that the driver holds.
OVERSAMPLE, MAX_SPLITTERS = 32, 2048
#: Rules of a bucket from which on more buckets are made: a sweep's work grows with their square.
BUCKET_RULES = 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    """Reversed host, a separator below every host character, then the path."""
    return F.encode(F.concat(F.concat_ws(".", labels), F.lit("\x01"), path), "UTF-8")


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _buckets(cuts: list[tuple[bytes, int]]) -> Callable[[Column, Column], Column]:
    """How many cuts lie at or below (key, h): first among every so many-th cut, then among the cuts behind it."""
    if not cuts:
        return lambda key, h: F.lit(0)
    one = lambda c: F.struct(F.lit(c[0]).alias("key"), F.lit(c[1]).alias("h"))
    step = isqrt(len(cuts)) + 1
    heads = F.array(*[one(c) for c in cuts[::step]])
    runs = F.array(*[F.array(*[one(c) for c in cuts[k : k + step]]) for k in range(0, len(cuts), step)])

    def find(key: Column, h: Column) -> Column:
        own = F.struct(key.alias("key"), h.alias("h"))
        below = lambda a: F.size(F.filter(a, lambda s: s <= own))
        head = below(heads)
        return F.when(head == 0, 0).otherwise((head - 1) * step + below(F.get(runs, head - 1)))

    return find


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` has columns host, path, verdict.  The longest fitting rule string
    (host + path) wins; among equals the longer host, then block before allow.
    A url that is null, empty or without ``://`` has empty host and path.

    A rule's canonical key is its reversed host plus path, so all keys it
    covers form one interval and rules nest.  A url contributes one key per
    label of its host.  Sampled splitters over (key, row hash) cut the key
    space evenly even where one url is a third of all rows; a rule goes to
    every bucket its interval meets.  In a bucket a sweep over the sorted rule
    ends keeps the stack of open rules, and each url key takes the top of the
    stack at the last end before it.
    """
    with temporary(pages.sparkSession) as lasting:
        return lasting(_verdicts(pages, rules, id_col, url_col, default), "verdicts")


def _verdicts(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str) -> DataFrame:
    spark = pages.sparkSession
    url = F.col(url_col)
    base = stored(pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("uid", F.monotonically_increasing_id()), "urls")
    empty = F.expr("X''")
    levels = base.withColumn("labels", _labels(F.col("host"))).withColumn("level", F.explode(F.sequence(F.lit(1), F.size("labels"))))
    keys = levels.select("uid", _key(F.slice("labels", F.lit(1), F.col("level")), F.col("path")).alias("key"), F.xxhash64("uid").alias("h"))

    lowest = F.lit(-(1 << 63))
    named = rules.select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"), "verdict", _key(_labels(F.col("host")), F.col("path")).alias("start"))
    named = named.groupBy("rule", "host_len", "start").agg(F.max("verdict").alias("verdict")).withColumn("end", F.concat("start", F.expr("X'FF'")))

    rows, n_rules = keys.count(), named.count()
    buckets = min(MAX_SPLITTERS, max(2 * shuffle_width(spark), n_rules // BUCKET_RULES))
    draw = F.pmod(F.xxhash64("uid", "key", F.lit(3)), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, buckets * OVERSAMPLE / max(rows, 1))))
    some = F.pmod(F.xxhash64("rule", F.lit(5)), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, buckets * OVERSAMPLE / max(n_rules, 1))))
    sample = sorted((bytes(r["key"]), r["h"]) for r in keys.where(draw).select("key", "h").collect())
    cuts = {sample[len(sample) * i // buckets] for i in range(1, buckets)} if sample else set()
    if n_rules >= BUCKET_RULES:  # many rules are cut as evenly as many keys
        starts = sorted(bytes(r["start"]) for r in named.where(some).select("start").collect())
        cuts |= {(starts[len(starts) * i // buckets], -(1 << 63)) for i in range(1, buckets)}
    bucket = _buckets(sorted(cuts))
    met = named.withColumns({"lo": bucket(F.col("start"), lowest), "hi": bucket(F.col("end"), lowest)}).withColumn("bucket", F.explode(F.sequence("lo", "hi")))
    top = "struct<len:int,host_len:int,block:boolean,rule:string,verdict:string>"
    entry = F.struct(F.length("rule").alias("len"), F.col("host_len").alias("host_len"), (F.col("verdict") == "block").alias("block"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))
    # ends sort before starts at one key; outer rules start first, being shorter
    events = met.select(
        "bucket",
        F.explode(
            F.array(
                F.struct(F.when(F.col("bucket") == F.col("lo"), F.col("start")).otherwise(empty).alias("key"), F.lit(1).alias("opens"), F.length("start").alias("depth"), entry.alias("entry")),
                F.struct(F.col("end").alias("key"), F.lit(0).alias("opens"), (-F.length("start")).alias("depth"), entry.alias("entry")),
            )
        ).alias("event"),
        "hi",
    ).where((F.col("event.opens") == 1) | (F.col("bucket") == F.col("hi")))
    swept = events.groupBy("bucket").agg(F.array_sort(F.collect_list("event")).alias("events")).selectExpr(
        "bucket",
        f"""explode(aggregate(events,
              named_struct('stack', CAST(array() AS array<{top}>), 'out', CAST(array() AS array<struct<key:binary,top:{top}>>)),
              (acc, e) -> named_struct(
                'stack', IF(e.opens = 1, concat(acc.stack, array(e.entry)), IF(size(acc.stack) > 0, slice(acc.stack, 1, size(acc.stack) - 1), acc.stack)),
                'out', concat(acc.out, array(named_struct('key', e.key, 'top',
                         IF(e.opens = 1, e.entry, get(acc.stack, size(acc.stack) - 2)))))),
              acc -> acc.out)) AS mark""",
        "1 AS one",
    )
    # several ends may share a key: the last one swept holds
    marks = swept.select("bucket", F.col("mark.key").alias("key"), lowest.alias("h"), F.lit(None).cast("long").alias("uid"), F.struct(F.col("mark.top").alias("top")).alias("mark"))
    asked = keys.select(bucket(F.col("key"), F.col("h")).alias("bucket"), "key", "h", "uid", F.lit(None).cast(f"struct<top:{top}>").alias("mark"))
    depth = F.coalesce(F.length(F.col("mark.top.rule")), F.lit(0))
    sweep = Window.partitionBy("bucket").orderBy("key", F.when(F.col("uid").isNull(), 0).otherwise(1), depth, "h").rowsBetween(Window.unboundedPreceding, 0)
    open_ = marks.unionByName(asked).withColumn("now", F.last("mark", True).over(sweep)).where(F.col("uid").isNotNull() & F.col("now.top").isNotNull())
    best = open_.groupBy("uid").agg(F.max("now.top").alias("top"))
    return base.join(best, "uid", "left").select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return apply_rules(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


SQL = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(rh, rp, v) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), m AS (
  SELECT page_id, host, path, rh || rp AS rule, v,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
