"""Personal data: base patterns and information-theoretic disclosure.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import stored, temporary

#: The contract's patterns, with possessive loops and run starts so that no text, however long, backtracks.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # whole digit runs of 12 to 19 digits; all other runs fail on their digit count
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
#: Terms are runs of letters and digits that start with a letter.
TERM = r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]*+"
#: A term discloses an entity if PMI(term; entity) reaches this share of the entity's information content.
DISCLOSES = 0.9
#: Letters of the endings to which a disclosing term may be generalised, longest first.
ENDINGS = (4, 3, 2)
#: Code points of the chunks in which a long text is cut.
CHUNK = 2048
_BLOCK = 256


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)


def _positions(text: Column, pattern: str, build: Callable[[Column, Column], Column]) -> Column:
    """``build(match, start)`` of each match; starts are prefix sums, in blocks to stay near linear."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    both = F.struct(found.alias("m"), gaps.alias("g"))

    def place(b: Column) -> Column:
        n = F.size(b["m"])
        steps = F.zip_with(b["m"], F.slice(b["g"], F.lit(1), n), lambda m, g: F.length(m) + g)
        return _let(F.struct(b["m"].alias("m"), b["g"].alias("g"), steps.alias("s")), with_blocks)

    def with_blocks(b: Column) -> Column:
        top = F.floor((F.size(b["s"]) - 1) / _BLOCK)
        sums = F.when(F.size(b["s"]) > 0, F.transform(F.sequence(F.lit(0).cast("long"), top), lambda k: _total(F.slice(b["s"], (k * _BLOCK + 1).cast("int"), F.lit(_BLOCK))))).otherwise(F.array().cast("array<bigint>"))
        return _let(F.struct(b["m"].alias("m"), b["g"].alias("g"), b["s"].alias("s"), sums.alias("k")), walk)

    def walk(b: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            front = _total(F.slice(b["k"], F.lit(1), block)) + _total(F.slice(b["s"], block * _BLOCK + 1, i - block * _BLOCK))
            return build(m, front + F.get(b["g"], i))

        return F.transform(b["m"], one)

    return _let(both, place)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value that ``body`` uses several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<start,rank,end,value>> of the base kinds, by start, then kind."""
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")
    hints = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"), "phone": F.contains(text, F.lit("+"))}

    def of_kind(rank: int, kind: str, pattern: str) -> Column:
        build = lambda m, at: F.struct(at.alias("start"), F.lit(rank).alias("rank"), (at + F.length(m)).alias("end"), m.alias("value"))
        return F.when(hints[kind], F.filter(_positions(text, pattern, build), lambda s: _valid(kind, s["value"]))).otherwise(none)

    found = [of_kind(rank, kind, pattern) for rank, (kind, pattern) in enumerate(PATTERNS.items())]
    return F.array_sort(F.concat(*found))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _scanned(docs: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """uid, doc_id, base, text (of rows with base spans only), stored; ``row`` too if the whole row is asked for."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    columns = ["doc_id", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")]
    return stored(rows.select(*columns, *(["row"] if whole else [])).withColumn("uid", F.monotonically_increasing_id()), "spans")


def _occurrences(scanned: DataFrame) -> DataFrame:
    """uid, term, start, end: every word of the texts that hold base spans."""
    found = F.regexp_extract_all("text", F.lit(TERM), 0)
    gaps = F.transform(F.split("text", TERM, -1), lambda g: F.length(g).cast("long"))
    words = scanned.where(F.size("base") > 0).select("uid", F.posexplode(F.arrays_zip(found.alias("m"), gaps.alias("g"))).alias("i", "w")).where("w.m IS NOT NULL")
    words = words.select("uid", "i", F.col("w.m").alias("m"), F.length("w.m").cast("long").alias("n"), F.col("w.g").alias("g"))
    up_to = Window.partitionBy("uid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("n") + F.col("g")).over(up_to)
    return words.withColumn("end", end).select("uid", F.lower("m").alias("term"), (F.col("end") - F.col("n")).alias("start"), "end")


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """term, with_term: how many documents hold each word."""
    words = F.transform(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TERM), 0)), F.lower)
    return docs.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))


def disclosing_terms(scanned: DataFrame, occurrences: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """uid, term, content: the terms of each document that reveal an entity in it, with the least content of those entities.

    One event space: documents.  p(t), p(e) and p(t, e) are the shares of
    ``total`` documents that hold the term, the entity, and both anywhere in
    their texts.  A term discloses an entity if PMI(t; e) = log p(t, e) / (p(t) p(e))
    reaches DISCLOSES of the entity's content, -log p(e); at 1 the term never
    occurs without the entity.  Entities are the values of base spans and, since
    most values are unique, every kind as a whole, whose degree is smoothed by one
    document in which the two have nothing to do with each other.  Values that
    stand in the same documents are one entity, so a text full of them costs no
    more than its words.  Pairs that the counts alone rule out are never met, and
    counts are sums, so no group is gathered in one task.
    """
    values = scanned.select("uid", F.explode(F.array_distinct(F.transform("base", lambda s: F.struct(s["rank"].alias("rank"), s["value"].alias("value"))))).alias("e")).select("uid", "e.rank", "e.value")
    by_value = values.groupBy("rank", "value").agg(F.count("*").alias("with_entity"), F.bit_xor(F.xxhash64("uid")).alias("entity"))
    own = values.join(by_value, ["rank", "value"]).select("uid", F.lit(False).alias("kind"), "entity", "with_entity").distinct()
    kinds = values.select("uid", "rank").distinct()
    by_kind = kinds.groupBy("rank").agg(F.count("*").alias("with_entity"))  # a row per kind
    whole = kinds.join(F.broadcast(by_kind), "rank").select("uid", F.lit(True).alias("kind"), F.col("rank").cast("long").alias("entity"), "with_entity")
    n = F.lit(float(total))
    content = F.log(n / F.col("with_entity"))
    holders = own.unionByName(whole).where(F.col("with_entity") < total).withColumn("content", content)
    terms = occurrences.select("uid", "term").distinct().join(counts, "term")
    possible = (F.col("with_term") < F.col("with_entity")) | (F.log(n / F.col("with_term")) >= DISCLOSES * F.col("content") - 1e-9)
    met = stored(holders.join(terms, "uid").where(possible), "met")
    keys = ["kind", "entity", "with_entity", "term"]
    both = met.groupBy(*keys).agg(F.count("*").alias("both"), F.first("with_term").alias("with_term"), F.first("content").alias("content"))
    pmi = F.log(n * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    trust = F.when(F.col("kind"), F.col("both") / (F.col("both") + 1)).otherwise(1.0)
    told = both.where(trust * pmi >= DISCLOSES * F.col("content") - 1e-9).select(*keys)
    return met.join(told, keys).groupBy("uid", "term").agg(F.min("content").alias("content"))


def generalised(flagged: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """uid, term, put: the ending that stands for the term's class of words, or nothing where every class discloses too.

    The class of an ending are all corpus words with that ending; it is at least
    as common as its commonest word, so its PMI with an entity is at most
    log(total / that count).  The longest ending for which this bound stays below
    DISCLOSES of the entity's content, and which several words share, is taken.
    """
    ends = lambda c: F.filter(F.array(*[F.when(F.length(c) > k, F.right(c, F.lit(k))) for k in ENDINGS]), lambda e: e.isNotNull())
    classes = counts.select(F.explode(ends(F.col("term"))).alias("ending"), "with_term").groupBy("ending").agg(F.max("with_term").alias("most"), F.count("*").alias("words")).where("words > 1")
    asked = flagged.select("uid", "term", "content", F.explode_outer(ends(F.col("term"))).alias("ending"))
    fits = F.log(F.lit(float(total)) / F.col("most")) < DISCLOSES * F.col("content")
    best = asked.join(classes, "ending", "left").withColumn("fit", F.when(fits, F.concat(F.lit("[-"), "ending", F.lit("]"))))
    return best.groupBy("uid", "term").agg(F.coalesce(F.max_by("fit", F.when(F.col("fit").isNotNull(), F.length("fit"))), F.lit("")).alias("put"))


def _all_spans(scanned: DataFrame, terms: DataFrame) -> DataFrame:
    """uid, start, rank, end, put, before: base spans and the terms (uid, start, end, put) that overlap none of them.

    ``before`` is the furthest end of the spans in front, 0 at first.
    """
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in PATTERNS])
    base = scanned.select("uid", F.explode("base").alias("s")).select("uid", "s.start", "s.rank", "s.end", F.element_at(labels, F.col("s.rank") + 1).alias("put"))
    every = base.unionByName(terms.select("uid", "start", F.lit(KINDS.index("term")).alias("rank"), "end", "put"))
    w = Window.partitionBy("uid").orderBy("start", "rank", "end")
    is_base = F.col("rank") < KINDS.index("term")
    front = F.coalesce(F.max(F.when(is_base, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.min(F.when(is_base, F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    clear = every.withColumn("front", front).withColumn("ahead", ahead).where(is_base | ((F.col("front") <= F.col("start")) & (F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True)))))
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return clear.select("uid", "start", "rank", "end", "put").withColumn("before", before)


def _found(scanned: DataFrame, docs: DataFrame, text_col: str, labels: bool) -> DataFrame:
    """The spans of ``_all_spans`` over ``docs``; ``put`` of terms only if ``labels`` are asked for."""
    total = scanned.count()
    occurrences = stored(_occurrences(scanned), "words")
    counts = stored(word_counts(docs, text_col), "counts")
    flagged = disclosing_terms(scanned, occurrences, counts, total)
    told = generalised(stored(flagged, "terms"), counts, total) if labels else flagged.select("uid", "term", F.lit("").alias("put"))
    return _all_spans(scanned, occurrences.join(told, ["uid", "term"]).select("uid", "start", "end", "put"))


def span_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row.

    Spans are in code points, end exclusive.  Null and empty texts have none;
    term spans lie only in documents that hold a base span and never overlap one.
    Repeated rows count as documents of their own; null ids are kept.
    """
    with temporary(docs.sparkSession) as lasting:
        scanned = _scanned(docs, id_col, text_col)
        spans = _found(scanned, docs, text_col, labels=False)
        every = spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("every"))
        number = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("long")
        rows = scanned.drop("text").join(every, "uid", "left")
        none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
        return lasting(rows.select("doc_id", *[number(r).alias(f"n_{k}") for r, k in enumerate(PATTERNS)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.coalesce("every", none)).alias("spans")), "found")


def _piece(chunks: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text held in chunks of CHUNK."""
    a, b = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    low, high = (start - a * CHUNK).cast("int"), (end - b * CHUNK).cast("int")
    at = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
    inner = F.array_join(F.slice(chunks, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
    return F.when(a == b, F.substring(at(a), low + 1, high - low)).otherwise(F.concat(F.substring(at(a), low + 1, F.lit(CHUNK)), inner, F.substring(at(b), F.lit(1), high)))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data out of the text: base spans become ``[EMAIL]`` and so on.

    A disclosing term becomes the ending of a class of words that does not
    disclose, ``[-ing]``, or goes where there is none (``generalised``).  Where
    spans overlap, the first is replaced and the rest of the overlap goes with it.
    Documents without a base span stay as they are, and so do all other columns
    but for ``count_col``, which gets the length of a text that changed; null
    texts stay null.
    """
    names = docs.columns
    with temporary(docs.sparkSession) as lasting:
        scanned = _scanned(docs, id_col, text_col, whole=True)
        spans = _found(scanned, docs, text_col, labels=True)
        cuts = spans.groupBy("uid").agg(F.max("end").alias("tail"), F.array_sort(F.collect_list(F.when(F.col("start") >= F.col("before"), F.struct("before", "start", "put")))).alias("cuts"))
        steps = F.sequence(F.lit(0), F.floor(F.length("text") / CHUNK).cast("int"))
        chunks = F.transform(steps, lambda k: F.substring("text", k * CHUNK + 1, F.lit(CHUNK)))
        touched = scanned.join(cuts, "uid").select("row", "tail", "cuts", F.length("text").cast("long").alias("n"), chunks.alias("chunks"))
        kept = F.transform("cuts", lambda c: F.concat(_piece(F.col("chunks"), c["before"], c["start"]), c["put"]))
        touched = touched.select("row", F.concat(F.array_join(kept, ""), _piece(F.col("chunks"), F.col("tail"), F.col("n"))).alias("new"))
        changed = {text_col: F.col("new"), count_col: F.length("new").cast("long")}
        done = touched.select(*[changed[n].alias(n) if n in changed else F.col(f"row.`{n}`").alias(n) for n in names])
        return lasting(scanned.where(F.size("base") == 0).select("row.*").unionByName(done), "sanitised")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))
