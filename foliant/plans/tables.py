"""Readers of the supplied tables and the derived relations that plans share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators import lines as L


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan over at least as many partitions as the cluster has cores, by ``keys``.

    Only small inputs are dealt anew, where the work on a row outweighs its
    shuffle: a scan that has partitions for all cores, as any large one has, stays
    as it is.  ``df`` must not shuffle yet.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > width else df.repartition(width, *keys)


#: Bytes of files to a task where a Python kernel works on every row.
TASK_BYTES = 2 << 20


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A scan over tasks of about ``TASK_BYTES`` of its files each, by ``keys``; at least as many as the cluster has cores.

    A split of a file without a row group of its own is an empty task and its
    neighbour a long one, so the scan stays as it is only if it has files enough.
    ``df`` must not shuffle yet.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return df if len(df.inputFiles()) >= tasks else df.repartition(tasks, *keys)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lines_of(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, role, a, b: each turn and the next one, whole texts, normalised."""
    turns = spread(table(spark, sf_dir, "conversations"), "conv_id").select("conv_id", "turn", "role", T.normalised_for_eval(F.col("text")).alias("a"))
    after = F.lead("a").over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.withColumn("b", after).where("b IS NOT NULL")


#: White space that both engines strip, as a character class.
SPACE = r"[\s\x{85}\x{a0}\x{2028}\x{2029}\x{3000}]"
#: The normal form of ``normalised_for_eval`` over a column, figures apart.
NORMALISED = (
    r"regexp_replace(translate(regexp_replace(regexp_replace(regexp_replace({c}, '^" + SPACE + r"+', ''), '" + SPACE + r"+$', ''), '\n+', E'\n', 'g'), "
    "(SELECT string_agg(chr(CAST(i AS INT)), '' ORDER BY i) FROM generate_series(65281, 65374) g(i)) || chr(12288), "
    "(SELECT string_agg(chr(CAST(i AS INT)), '' ORDER BY i) FROM generate_series(33, 126) g(i)) || ' '), '\\[IMAGE[^\\]]*\\]', '[IMAGE_TOKEN]', 'g')"
)
TURN_PAIRS = f"""
t AS (
  SELECT conv_id, turn, role, {NORMALISED.replace('{c}', "coalesce(text, '')")} AS a FROM conversations
), pairs AS (
  SELECT * FROM (SELECT *, lead(a) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM t) WHERE b IS NOT NULL
)"""

LINES = r"""
lines AS (
  SELECT doc_id, unnest(generate_series(0, len(string_split(text, E'\n')) - 1)) AS line_no, unnest(string_split(text, E'\n')) AS line FROM documents
)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, box_id, column, width, x1, y1, x2, y2, score, label from lineitem arithmetic."""
    li = table(spark, sf_dir, "lineitem")
    x = F.pmod("l_partkey", F.lit(3)) * 200 + F.pmod("l_suppkey", F.lit(40))
    y = F.pmod(F.col("l_partkey") * 7 + F.col("l_suppkey"), F.lit(700))
    return li.select(
        F.col("l_orderkey").alias("page_id"),
        (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("box_id"),
        F.pmod("l_partkey", F.lit(3)).cast("int").alias("column"),
        F.lit(600.0).alias("width"),
        x.cast("double").alias("x1"),
        y.cast("double").alias("y1"),
        (x + 100 + F.col("l_quantity")).cast("double").alias("x2"),
        (y + 60 + F.col("l_quantity") * 4).cast("double").alias("y2"),
        (1 - F.col("l_discount") * 5).alias("score"),
        F.when(F.col("l_returnflag") == "A", "formula").when(F.col("l_returnflag") == "R", "reference").otherwise("text").alias("label"),
    )


BOXES = """
boxes AS (
  SELECT l_orderkey AS page_id, l_linenumber * 1000000 + l_partkey AS box_id, CAST(l_partkey % 3 AS INT) AS "column", 600.0::DOUBLE AS width,
    CAST(l_partkey % 3 * 200 + l_suppkey % 40 AS DOUBLE) AS x1, CAST((l_partkey * 7 + l_suppkey) % 700 AS DOUBLE) AS y1,
    l_partkey % 3 * 200 + l_suppkey % 40 + 100 + l_quantity AS x2, (l_partkey * 7 + l_suppkey) % 700 + 60 + l_quantity * 4 AS y2,
    1 - l_discount * 5 AS score, CASE l_returnflag WHEN 'A' THEN 'formula' WHEN 'R' THEN 'reference' ELSE 'text' END AS label
  FROM lineitem
)"""
