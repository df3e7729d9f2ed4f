"""Evaluation: edit distance, BLEU, token sets, formulas, modalities, token statistics, system deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import formulas as X
from foliant.functions import kernels as K
from foliant.functions import metrics as M
from foliant.functions import text as T
from foliant.operators import corpus as C
from foliant.operators import scores as S
from foliant.sources import records as R

from .tables import NORMALISED, TURN_PAIRS, spread, table, turn_pairs

LIMITS = (1500, 2048, 4096)


def ned_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = M.edit_distance_share(F.col("a"), F.col("b"))
    return turn_pairs(spark, sf_dir).groupBy("role").agg(F.count("*").alias("n_samples"), F.round(F.avg(1 - d), 6).alias("ned"), F.round(F.avg(d), 6).alias("distance"))


#: DuckDB's distance counts bytes: every other character that occurs gets one of 26 unused control codes.
_CODES = "|| ".join(f"chr({i})" for i in [*range(1, 9), *range(14, 32)])
CODED = f"""
others AS (SELECT coalesce(string_agg(c, '' ORDER BY c), '') AS f FROM (SELECT DISTINCT unnest(string_split(a || b, '')) AS c FROM pairs) WHERE unicode(c) > 126), coded AS (
  SELECT conv_id, turn, role, translate(a, f, {_CODES}) AS a, translate(b, f, {_CODES}) AS b FROM pairs, others
)"""
_NED = "CASE WHEN length({x}) >= 4 AND length(b) >= 4 THEN levenshtein({x}, b) / greatest(length({x}), length(b)) END"
NED_BY_ROLE = f"""
WITH {TURN_PAIRS}, {CODED}, d AS (SELECT role, {_NED.format(x="a")} AS d FROM coded)
SELECT role, count(*) AS n_samples, round(avg(1 - d), 6) AS ned, round(avg(d), 6) AS distance FROM d GROUP BY role"""


def token_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, r = M.precision_recall(T.words(F.col("a")), T.words(F.col("b")))
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", p.alias("p"), r.alias("r")).select("conv_id", "turn", F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"), F.round(M.f_measure(F.col("p"), F.col("r")), 6).alias("f"))


_WORDS = r"list_filter(regexp_split_to_array({c}, '\s+'), lambda w: w <> '')"
TOKEN_PRF = f"""
WITH {TURN_PAIRS}, s AS (SELECT conv_id, turn, list_distinct({_WORDS.format(c="a")}) AS h, list_distinct({_WORDS.format(c="b")}) AS r FROM pairs), q AS (
  SELECT conv_id, turn, CASE WHEN len(h) > 0 THEN len(list_intersect(h, r)) / len(h) END AS p, CASE WHEN len(r) > 0 THEN len(list_intersect(h, r)) / len(r) END AS r FROM s
)
SELECT conv_id, turn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END, 6) AS f FROM q"""


def token_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(F.size(F.filter(F.split("text", r"[ \n\t]+"), lambda w: w != "")).alias("n"))
    stats = [F.count("*").alias("n_pages"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_pop("n"), 6).alias("std")]
    stats += [F.round(F.percentile("n", F.lit(q / 100)), 6).alias(f"p{q}") for q in (50, 90, 95, 99)]
    for limit in LIMITS:
        stats += [F.count_if(F.col("n") > limit).alias(f"over_{limit}"), F.round(100 * F.count_if(F.col("n") > limit) / F.count("*"), 6).alias(f"percent_{limit}")]
    return n.agg(*stats)


TOKEN_LENGTH_STATS = r"""
WITH t AS (SELECT len(list_filter(regexp_split_to_array(text, '[ \n\t]+'), lambda w: w <> '')) AS n FROM documents)
SELECT count(*) AS n_pages, CAST(min(n) AS INT) AS least, CAST(max(n) AS INT) AS most, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std,
  round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99,
""" + ", ".join(f"count(*) FILTER (n > {k}) AS over_{k}, round(100 * count(*) FILTER (n > {k}) / count(*), 6) AS percent_{k}" for k in LIMITS) + " FROM t"


def _bleu(a: Column, b: Column) -> Column:
    return F.when(M.measured(a, b), K.column(K.bleu4, "double", a, b))


def bleu_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence BLEU-4 by role: samples, mean, median."""
    scored = turn_pairs(spark, sf_dir).select("role", _bleu(F.col("a"), F.col("b")).alias("bleu"))
    return scored.groupBy("role").agg(F.count("*").alias("n_samples"), F.round(F.avg("bleu"), 6).alias("bleu"), F.round(F.median("bleu"), 6).alias("middle"))


def bleu_sql(source: str, keys: str, a: str, b: str, out: str) -> str:
    """CTEs that give BLEU-4 of column ``a`` against ``b`` of ``source`` in table ``out`` (keys, bleu)."""
    return f"""
{out}_w AS (SELECT {keys}, {_WORDS.format(c=a)} AS h, {_WORDS.format(c=b)} AS r FROM {source} WHERE length({a}) >= 4 AND length({b}) >= 4), {out}_n AS (SELECT *, unnest([1, 2, 3, 4]) AS n FROM {out}_w), {out}_g AS (
  SELECT {keys}, n, unnest(list_transform(generate_series(1, len(h) - n + 1), lambda i: array_to_string(h[i:i + n - 1], chr(1)))) AS g, 1 AS p, 0 AS t FROM {out}_n
  UNION ALL SELECT {keys}, n, unnest(list_transform(generate_series(1, len(r) - n + 1), lambda i: array_to_string(r[i:i + n - 1], chr(1)))), 0, 1 FROM {out}_n
), {out}_c AS (SELECT {keys}, n, g, sum(p) AS p, sum(t) AS t FROM {out}_g GROUP BY ALL), {out}_s AS (
  SELECT {keys}, n, sum(least(p, t)) AS hits, sum(p) AS total FROM {out}_c GROUP BY ALL
), {out}_l AS (
  SELECT {out}_n.{keys.replace(', ', f', {out}_n.')}, n, len(h) AS lh, len(r) AS lr, coalesce(hits, 0) AS hits, coalesce(total, 0) AS total FROM {out}_n LEFT JOIN {out}_s USING ({keys}, n)
), {out} AS (
  SELECT {keys}, CASE WHEN max(CASE WHEN n = 1 THEN hits END) = 0 THEN 0 ELSE exp(sum(ln((CASE WHEN hits = 0 THEN 0.1::DOUBLE ELSE hits END) / greatest(total, 1)) / 4) + least(0, 1 - max(lr) / greatest(max(lh), 1))) END AS bleu FROM {out}_l GROUP BY ALL
)"""


BLEU_MEAN = f"""
WITH {TURN_PAIRS}, {bleu_sql("pairs", "conv_id, turn", "a", "b", "s")}
SELECT role, count(*) AS n_samples, round(avg(bleu), 6) AS bleu, round(median(bleu), 6) AS middle FROM pairs LEFT JOIN s USING (conv_id, turn) GROUP BY role"""


# -- formulas -------------------------------------------------------------------------
#: Put in front of documents by id mod 6: every delimiter, escaped ones, double dollars, none at all.
_TEX = [r"$a+b$ and \(x_1\) ", r"$$\int y$$ \[ z \] $c$ ", r"\(p\) \(q\) \[r\$s\] ", "plain ", r"$a+b$ \(x_1\) $c$ ", r"\( open \[ z \] "]


def _with_tex(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.withColumn("text", F.concat(F.element_at(F.array(*map(F.lit, _TEX)), (F.col("doc_id") % len(_TEX) + 1).cast("int")), "text"))


_WITH_TEX = f"""tex AS (SELECT doc_id, lang, ([{", ".join(f"'{x}'" for x in _TEX)}])[CAST(doc_id % {len(_TEX)} AS INT) + 1] || text AS text FROM documents)"""
_BODIES = r"""list_concat(regexp_extract_all({c}, '(?s)\$(.*?[^\\])\$', 1), regexp_extract_all({c}, '(?s)\\\((.*?[^\\])\\\)', 1),
    regexp_extract_all({c}, '(?s)\$\$(.*?[^\\])\$\$', 1), regexp_extract_all({c}, '(?s)\\\[(.*?[^\\])\\\]', 1))"""


def formula_micro_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas of even documents as predictions, of the odd ones after them as truth, by language."""
    docs = _with_tex(spark, sf_dir).select("lang", "doc_id", F.explode(K.column(X.bodies, "array<string>", F.col("text"))).alias("formula"))
    keyed = docs.withColumn("pair", F.floor(F.col("doc_id") / 2))
    hits = S.multiset_hits(keyed.where("doc_id % 2 = 0"), keyed.where("doc_id % 2 = 1"), ["lang", "pair"], "formula")
    return S.micro_prf(hits, ["lang"])


FORMULA_MICRO_PRF = f"""
WITH {_WITH_TEX}, f AS (SELECT lang, doc_id // 2 AS pair, doc_id % 2 AS side, trim(unnest({_BODIES.format(c="text")}), E' \\n\\t') AS formula FROM tex), c AS (
  SELECT lang, pair, formula, count(*) FILTER (side = 0) AS p, count(*) FILTER (side = 1) AS t FROM f GROUP BY ALL
), m AS (
  SELECT lang, sum(least(p, t)) AS tp, sum(p) AS p, sum(t) AS t FROM c GROUP BY lang
), r AS (
  SELECT lang, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS p, CASE WHEN t > 0 THEN tp / t ELSE 0 END AS r FROM m
)
SELECT lang, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM r"""


def formula_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tex(spark, sf_dir).select("doc_id", F.array_join(K.column(X.bodies, "array<string>", F.col("text")), "|").alias("formulas"))


FORMULA_BODIES = f"WITH {_WITH_TEX} SELECT doc_id, array_to_string(list_transform({_BODIES.format(c='text')}, lambda x: trim(x, E' \\n\\t\\r')), '|') AS formulas FROM tex"


def modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, math and tables of every document with formulas and a table put in."""
    docs = _with_tex(spark, sf_dir).withColumn("text", F.concat(F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.lit("\n\\begin{tabular}{c} a \\\\ b \\end{tabular} after")).otherwise(F.lit("\n\\begin{tabular} open"))))
    split = K.column(X.modalities, "struct<text:string,math:string,tables:string>", F.col("text"))
    return docs.select("doc_id", split.alias("m")).select("doc_id", "m.*")


MODALITIES = rf"""
WITH {_WITH_TEX}, t AS (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN E'\n' || '\begin{{tabular}}{{c}} a \\ b \end{{tabular}} after' ELSE E'\n' || '\begin{{tabular}} open' END AS x FROM tex), i AS (
  SELECT doc_id, array_to_string(regexp_extract_all(x, '\\\((|.*?[^\\\n])\\\)', 1), E'\n') AS inl, regexp_replace(x, '\\\((|.*?[^\\\n])\\\)', '', 'g') AS x FROM t
), d AS (
  SELECT doc_id, inl || array_to_string(regexp_extract_all(x, '\\\[(.*?[^\\\n])\\\]', 1), E'\n') AS math, regexp_replace(x, '\\\[(.*?[^\\\n])\\\]', '', 'g') AS x FROM i
)
SELECT doc_id, trim(regexp_replace(x, '(?s)\\begin\{{tabular\}}(.+?)(?:\\end\{{tabular\}}|$)', '', 'g'), E' \n\t\r') AS text, math,
  array_to_string(regexp_extract_all(x, '(?s)\\begin\{{tabular\}}(.+?)(?:\\end\{{tabular\}}|$)', 1), E'\n') AS tables FROM d"""


#: Figure forms put in front of documents by id mod 4.
_FIGURES = ["", "[FIGURE:F1]\n[FIGURE_TITLE]x[END_FIGURE_TITLE]\n[END_FIGURE]\n\n", "[FIGURE_COORDS](0.1,0.2)[END_FIGURE_COORDS] ", "Ａ１　[IMAGE_x9] [END_FIGURE] "]


def normalize_for_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal form of every document with figure forms put in."""
    put = F.element_at(F.array(*map(F.lit, _FIGURES)), (F.col("doc_id") % len(_FIGURES) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", T.normalised_for_eval(F.concat(put, F.coalesce("text", F.lit("")))).alias("text"))


_FIGURE_SQL = "([" + ", ".join("E'" + x.replace("\n", "\\n") + "'" for x in _FIGURES) + f"])[CAST(doc_id % {len(_FIGURES)} AS INT) + 1] || coalesce(text, '')"
NORMALIZE_FOR_EVAL = r"""
SELECT doc_id, regexp_replace(regexp_replace(""" + NORMALISED.replace("{c}", _FIGURE_SQL) + r""", '(?s)\[FIGURE:.*?\].*?\[END_FIGURE\]', '[IMAGE_TOKEN]', 'g'), '(?s)\[FIGURE_COORDS\]\(.*?\)\[END_FIGURE_COORDS\]', '[IMAGE_TOKEN]', 'g') AS text FROM documents"""


# -- two systems ------------------------------------------------------------------------
def _systems(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """idx, prediction, truth of two systems: a turn without its long words, and the whole turn; the second lacks every eleventh sample."""
    pairs = turn_pairs(spark, sf_dir).withColumn("idx", F.col("conv_id") * 1000 + F.col("turn"))
    short = F.array_join(F.filter(T.words(F.col("a")), lambda w: F.length(w) <= 6), " ")
    return pairs.select("idx", short.alias("prediction"), F.col("b").alias("truth")), pairs.where("idx % 11 <> 0").select("idx", F.col("a").alias("prediction"), F.col("b").alias("truth"))


def eval_summary_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples, NED and BLEU of two systems joined by position, and their differences; null where either has none."""
    both = C.by_position(*_systems(spark, sf_dir))
    scores = [F.count("*").alias("n_samples")]
    for name in ("base", "fine"):
        x, b = F.col(name), F.col("truth")
        scores += [C.valid_mean(1 - M.edit_distance_share(x, b)).alias(f"{name}_ned"), C.valid_mean(_bleu(x, b)).alias(f"{name}_bleu")]
    means = both.agg(*scores)
    names = [c for c in means.columns if c != "n_samples"]
    return means.select("n_samples", *[F.round(c, 6).alias(c) for c in names], *[F.round(F.col(f"fine_{m}") - F.col(f"base_{m}"), 6).alias(f"delta_{m}") for m in ("ned", "bleu")])


EVAL_SUMMARY_DELTA = f"""
WITH {TURN_PAIRS}, {CODED}, two AS (
  SELECT conv_id, turn, a AS fine, array_to_string(list_filter({_WORDS.format(c="a")}, lambda w: length(w) <= 6), ' ') AS base, b FROM coded WHERE (conv_id * 1000 + turn) % 11 <> 0
), {bleu_sql("two", "conv_id, turn", "base", "b", "x")}, {bleu_sql("two", "conv_id, turn", "fine", "b", "y")}, m AS (
  SELECT count(*) AS n_samples, avg(1 - {_NED.format(x="base")}) AS base_ned, avg(x.bleu) AS base_bleu, avg(1 - {_NED.format(x="fine")}) AS fine_ned, avg(y.bleu) AS fine_bleu
  FROM two LEFT JOIN x USING (conv_id, turn) LEFT JOIN y USING (conv_id, turn)
)
SELECT n_samples, round(base_ned, 6) AS base_ned, round(base_bleu, 6) AS base_bleu, round(fine_ned, 6) AS fine_ned, round(fine_bleu, 6) AS fine_bleu,
  round(fine_ned - base_ned, 6) AS delta_ned, round(fine_bleu - base_bleu, 6) AS delta_bleu FROM m"""


def formula_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro precision, recall and F1 of the formulas of two systems by language, and their differences.

    The first system gives every odd document's formulas for the even one before
    it, the second the even one's own without those of length one.
    """
    docs = _with_tex(spark, sf_dir).select("lang", "doc_id", F.explode(K.column(X.bodies, "array<string>", F.col("text"))).alias("formula")).withColumn("pair", F.floor(F.col("doc_id") / 2))
    truth = docs.where("doc_id % 2 = 0")
    made = {"base": docs.where("doc_id % 2 = 1"), "fine": truth.where("length(formula) > 1")}
    out = None
    for name, found in made.items():
        prf = S.micro_prf(S.multiset_hits(found, truth, ["lang", "pair"], "formula"), ["lang"])
        prf = prf.select("lang", *[F.col(c).alias(f"{name}_{c}") for c in ("precision", "recall", "f1")])
        out = prf if out is None else out.join(prf, "lang")
    return out.select("*", *[F.round(F.col(f"fine_{c}") - F.col(f"base_{c}"), 6).alias(f"delta_{c}") for c in ("precision", "recall", "f1")])


def _micro(name: str, made: str) -> str:
    return f"""{name}_c AS (SELECT lang, pair, formula, sum(p) AS p, sum(t) AS t FROM (SELECT lang, pair, formula, 1 AS p, 0 AS t FROM f WHERE {made} UNION ALL SELECT lang, pair, formula, 0, 1 FROM f WHERE side = 0) GROUP BY ALL),
{name}_m AS (SELECT lang, sum(least(p, t)) AS tp, sum(p) AS p, sum(t) AS t FROM {name}_c GROUP BY lang), {name}_r AS (SELECT lang, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS p, CASE WHEN t > 0 THEN tp / t ELSE 0 END AS r FROM {name}_m),
{name} AS (SELECT lang, round(p, 6) AS {name}_precision, round(r, 6) AS {name}_recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS {name}_f1 FROM {name}_r)"""


FORMULA_DELTA = f"""
WITH {_WITH_TEX}, f AS (SELECT lang, doc_id // 2 AS pair, doc_id % 2 AS side, trim(unnest({_BODIES.format(c="text")}), E' \\n\\t') AS formula FROM tex), {_micro("base", "side = 1")}, {_micro("fine", "side = 0 AND length(formula) > 1")}
SELECT *, round(fine_precision - base_precision, 6) AS delta_precision, round(fine_recall - base_recall, 6) AS delta_recall, round(fine_f1 - base_f1, 6) AS delta_f1 FROM base JOIN fine USING (lang)"""


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of one system a conversation, user turns as predictions and the others as truths, loaded and cut to the shorter."""
    turns = table(spark, sf_dir, "conversations")
    held = lambda who: F.transform(F.array_sort(F.collect_list(F.when(who, F.struct("turn", "text")))), lambda t: t["text"])
    results = turns.groupBy("conv_id").agg(held(F.col("role") == "user").alias("predictions"), held(F.col("role") != "user").alias("ground_truths"))
    return R.result_rows(results)


RESULT_ROWS = """
WITH r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id, role = 'user' ORDER BY turn) - 1 AS idx, role = 'user' AS u, text FROM conversations)
SELECT a.conv_id, CAST(a.idx AS INT) AS idx, a.text AS prediction, b.text AS truth FROM r a JOIN r b ON a.conv_id = b.conv_id AND a.idx = b.idx AND a.u AND NOT b.u"""


def metric_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain means of word overlap by role, NaN where the next turn has fewer than three words, and the mean of valid values."""
    p, r = M.precision_recall(T.words(F.col("a")), T.words(F.col("b")))
    scores = turn_pairs(spark, sf_dir).select("role", F.when(F.size(T.words(F.col("b"))) < 3, F.lit(float("nan"))).otherwise(p).alias("p"), r.alias("r"))
    plain = C.metric_means(scores, ["role"], ["p", "r"])
    valid = scores.groupBy("role").agg(F.round(C.valid_mean(F.col("p")), 6).alias("valid_p"))
    return plain.join(valid, "role").select("role", F.isnan("p").alias("p_is_nan"), F.round("r", 6).alias("r"), "valid_p")


METRIC_MEANS = f"""
WITH {TURN_PAIRS}, s AS (SELECT role, list_distinct({_WORDS.format(c="a")}) AS h, list_distinct({_WORDS.format(c="b")}) AS r, len({_WORDS.format(c="b")}) AS n FROM pairs), q AS (
  SELECT role, n, CASE WHEN len(h) > 0 THEN len(list_intersect(h, r)) / len(h) END AS p, CASE WHEN len(r) > 0 THEN len(list_intersect(h, r)) / len(r) END AS r FROM s
)
SELECT role, count(*) FILTER (n < 3) > 0 OR count(p) = 0 AS p_is_nan, round(avg(r), 6) AS r, round(avg(p) FILTER (n >= 3), 6) AS valid_p FROM q GROUP BY role"""

_NAMES = "ned_by_role token_prf token_length_stats bleu_mean formula_micro_prf formula_bodies modalities normalize_for_eval eval_summary_delta formula_delta result_rows metric_means".split()
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
