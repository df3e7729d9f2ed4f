"""MinHash near-dedup by an inverted join on signature coordinates."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .slices import CACHE_ENTRIES, hold, map_slices
from .storage import brief_shuffles, discard, stored, temporary

#: Minima that make up one coordinate.  With one, unrelated texts meet by chance in numbers that grow with
#: the square of the corpus; with two, the chance is squared.
MINIMA = 2
#: Coordinates of a signature, and matches that a pair needs to be confirmed.  A pair at similarity
#: 0.85 (0.8) misses 9 of 32 matches with probability below 1e-7 (2e-5).
COORDINATES, MATCHES = 32, 9
#: A pair with MATCHES matches shares one of these many coordinates in any common order.
PREFIX = COORDINATES - MATCHES + 1
#: Cells of the token frequency table that orders coordinates, rarest first; it bounds what the driver holds.
CELLS = 1 << 16

_SEEDS = np.random.default_rng(20_011).integers(1, 1 << 63, size=(2, COORDINATES * MINIMA), dtype=np.uint64) | np.uint64(1)
_words: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _number(word: bytes) -> int:
    got = xxhash.xxh64_intdigest(word)
    if len(_words) >= CACHE_ENTRIES:
        _words.clear()
    if len(word) <= 64:
        _words[word] = got
    return got


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z lower-cased, ASCII white space parts words.

    Sets of hashes stand for sets of shingles: two texts of ten thousand shingles
    in all are counted wrong, by one, with probability 3e-12, and only a pair
    exactly at the threshold is judged by that one.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = _words
    h = np.array([known[w] if w in known else _number(w) for w in words], dtype=np.uint64)
    take = min(width, len(h))
    out = h[: len(h) - take + 1]
    for k in range(1, take):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - take + 1 + k])
    # shorter texts are one sequence, told apart from shingles of that width by its length
    return np.unique(_mix(out ^ np.uint64(take)))


def signature(s: np.ndarray) -> np.ndarray:
    """Each coordinate's least hash values over the set, mixed into one 32-bit integer."""
    out = np.full(COORDINATES * MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 512):
        part = (s[at : at + 512, None] * _SEEDS[0] + _SEEDS[1]) >> np.uint64(16)
        np.minimum(out, part.min(axis=0), out=out)
    least = out.reshape(COORDINATES, MINIMA)
    mixed = least[:, 0]
    for k in range(1, MINIMA):
        mixed = _mix(mixed) + least[:, k]
    return _mix(mixed).astype(np.uint32).view(np.int32)


def components(links: DataFrame) -> DataFrame:
    """node, comp from links (a, b): least label by neighbours and pointer jumps, in stored rounds."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    before = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
    while before is not None:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "comp")
        least = labels.unionByName(near).groupBy("node").agg(F.min("comp").alias("comp"))
        roots = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        jumped = stored(least.join(roots, "comp", "left").select("node", F.least("comp", F.coalesce("root", "comp")).alias("comp")), "labels")
        discard(labels)
        labels = jumped
        after = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if after == before:
            break
        before = after
    discard(both)
    return labels


#: Nodes whose keys are broadcast when their texts are fetched; more of them are fetched by a shuffled join.
BROADCAST_NODES = 1_000_000


class _Run:
    """One run of near-dedup over a table."""

    def __init__(self, docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> None:
        self.spark, self.width, self.percent = docs.sparkSession, width, percent
        self.rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def signed(self) -> DataFrame:
        width = self.width

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            hold("minhash", _words)
            size, digest, signs = [], [], []
            for text in batch["text"]:
                s = shingles(text, width)
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(signature(s) if len(s) else None)
            return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"], "n_shingles": size, "digest": digest, "sign": signs})

        out = map_slices(self.rows, run, "doc_id long, text_hash long, n_shingles long, digest binary, sign array<int>")
        return stored(out.withColumn("uid", F.monotonically_increasing_id()), "signed")

    def sets(self, nodes: DataFrame, keys: DataFrame) -> DataFrame:
        """node, items: the full sets of ``nodes``, from the texts, in 64-bit hashes."""
        width = self.width
        wanted = keys.join(nodes.select("node").distinct(), "node").select("node", "text_hash", F.col("doc_id").alias("of"))
        if wanted.count() <= BROADCAST_NODES:
            wanted = F.broadcast(wanted)
        texts = self.rows.join(wanted, (self.rows["text_hash"] == wanted["text_hash"]) & self.rows["doc_id"].eqNullSafe(wanted["of"])).select("node", "text")

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            hold("minhash", _words)
            return pd.DataFrame({"node": batch["node"], "items": [shingles(t, width).view(np.int64) for t in batch["text"]]})

        return stored(map_slices(texts, run, "node long, items array<long>"), "sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold on full sets; a hub's many pairs are split by the join's skew handling."""
        one = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
        two = one.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
        both = F.size(F.array_intersect("x", "y"))
        linked = two.withColumn("both", both).where(100 * F.col("both") >= self.percent * (F.size("x") + F.size("y") - F.col("both")))
        return stored(linked.select("a", "b").distinct(), "links")

    def postings(self, nodes: DataFrame) -> DataFrame:
        """node, common, tokens: each node's PREFIX rarest coordinates, in an order that all nodes share."""
        token = F.transform("sign", lambda v, k: F.xxhash64(k, v))
        cells = nodes.select(F.explode(token).alias("t")).groupBy(F.pmod("t", F.lit(CELLS)).alias("cell")).agg(F.count("*").alias("n")).collect()
        counts = np.zeros(CELLS, dtype=np.int64)
        for r in cells:
            counts[r["cell"]] = r["n"]
        held = self.spark.sparkContext.broadcast(counts)

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            t = np.stack(batch["t"].to_numpy())
            n = held.value[t % CELLS]
            first = np.take_along_axis(t, np.lexsort((t, n), axis=1)[:, :PREFIX], 1)
            return pd.DataFrame({"node": batch["node"], "common": np.log1p(n).sum(axis=1).round(6), "tokens": list(first)})

        return stored(map_slices(nodes.select("node", token.alias("t")), run, "node long, common double, tokens array<long>"), "postings")

    def matching(self, counted: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) of (a, b, hits) that match in MATCHES coordinates.

        ``hits`` collisions were counted in the merged prefix lists; only pairs
        that these leave undecided probe the lists that were skipped, by their
        signatures.
        """
        sure, open_ = counted.where(F.col("hits") >= MATCHES).select("a", "b"), counted.where(F.col("hits") < MATCHES).select("a", "b")
        signs = nodes.select("node", "sign")
        both = open_.join(signs.toDF("a", "sa"), "a").join(signs.toDF("b", "sb"), "b")
        matches = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, m: s + m)
        return stored(sure.unionByName(both.where(matches >= MATCHES).select("a", "b")), "pairs")

    def lists(self, posts: DataFrame) -> DataFrame:
        """token, node, hub, n: the posting lists of several nodes, with each list's commonest node and its length."""
        rows = posts.select(F.explode("tokens").alias("token"), "node", "common")
        hubs = rows.groupBy("token").agg(F.max(F.struct("common", -F.col("node"))).alias("top"), F.count("*").alias("n")).where("n > 1").select("token", (-F.col("top.col2")).alias("hub"), "n")
        return stored(rows.select("token", "node").join(hubs, "token"), "lists")

    def star_pairs(self, lists: DataFrame, nodes: DataFrame) -> DataFrame:
        """Each posted node with the commonest node of its list, if enough coordinates match."""
        pairs = lists.where("node <> hub").groupBy(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).agg(F.count("*").alias("hits"))
        return self.matching(stored(pairs, "collisions"), nodes)

    def cross_pairs(self, lists: DataFrame, comps: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """Pairs that share a posting but no component yet and may still reach the threshold; and their sets.

        Each list has a hub, its commonest node, with which all its nodes have
        been compared, so only lists whose other nodes are of several components
        are open.  The pairs of short ones are counted as they are; in longer ones
        what two nodes can share is bounded twice, and a pair is met only where a
        bound allows it, in a second inverted join on rare shingles (``_met``): by
        their sets as they are, and by what sets them apart from a centre that
        both resemble (``_apart``).  Nodes that hold too many shingles of their
        own drop out first.
        """
        labelled = lists.join(comps, "node", "left").select("token", "n", "node", F.coalesce("comp", "node").alias("comp"), "hub")
        open_lists = labelled.where("node <> hub").groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
        mixed = stored(labelled.join(open_lists, "token"), "mixed")
        if mixed.isEmpty():
            return None
        short = self._short_pairs(mixed.where(F.col("n") <= SHORT_LIST), nodes)
        spokes = mixed.where(F.col("n") > SHORT_LIST).select("node", "comp", "hub").distinct()
        deals = spokes.groupBy("hub").agg(F.ceil(F.count("*") / DEAL).cast("int").alias("deals"))
        spokes = stored(spokes.join(deals, "hub"), "spokes")
        open_ = spokes.select("node", "comp").distinct()
        wanted = open_.select("node").unionByName(short.select(F.col("a").alias("node"))).unionByName(short.select(F.col("b").alias("node")))
        sets = self.sets(wanted, nodes.select("node", "doc_id", "text_hash"))
        own = sets.join(open_, "node")
        alone = own.select("node", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count("*").alias("u"))
        s, u = F.size("items"), F.coalesce("u", F.lit(0))
        live = stored(own.join(alone, "node", "left").where(100 * (s - u) >= self.percent * s).select("node", "comp", "items"), "live")
        hubs = stored(sets.select(F.col("node").alias("hub"), F.col("items").alias("centre")).join(spokes.select("hub", "deals").distinct(), "hub"), "hubs")
        x = _dealt(spokes.select("node", "hub", "deals").join(live, "node"), hubs, "hub")
        shared = F.size(F.array_intersect("items", "centre"))
        near = x.select("node", "comp", "hub", "deals", "items", (shared / (F.size("items") + F.size("centre") - shared)).alias("like"))
        near = stored(near, "near")
        # a linked pair is less than 1 - percent / 100 apart in likeness to any third set
        far = near.where(F.col("like") < RESEMBLES + (100 - self.percent) / 100).select("node").distinct()
        plain = live.join(far, "node").select("node", "comp", F.lit(-1).cast("long").alias("hub"), F.lit(0).alias("side"), F.col("items").alias("d"), (-F.floor(-F.size("items") * self.percent / 100)).cast("long").alias("need"))
        apart, direct = self._apart(near.where(F.col("like") >= RESEMBLES), hubs)
        bounded = stored(plain.unionByName(apart), "bounded")
        for done in (live, near, hubs):
            discard(done)
        met = self._met(bounded)
        return stored(met.unionByName(direct).unionByName(short).distinct(), "pairs"), sets

    def _short_pairs(self, mixed: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) of rows (token, node, comp, hub) from different components that share a list and match in MATCHES coordinates."""
        rest = mixed.where("node <> hub")
        x, y = rest.alias("x"), rest.alias("y")
        ends = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") < F.col("y.comp"))).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        return self.matching(stored(ends.groupBy("a", "b").agg(F.count("*").alias("hits")), "collisions"), nodes)

    def _apart(self, near: DataFrame, hubs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows for ``_met`` of what sets nodes (node, comp, hub, items) apart from their hub's centre; and pairs that the centre proves.

        A hub's centre are the shingles that most of its nodes hold, or its own
        where it has few.  With d the difference from the centre, two nodes are
        linked just if they share (w + w') / 2 of their differences, where w is
        |d| less percent's part of the size.  Let m be the node of least w.  Those
        with w + w_m <= 0 are linked with m (``direct``), so every other pair that
        is still open has a member above -w_m, which bounds what the other one
        must share.
        """
        big = near.groupBy("hub").agg(F.count("*").alias("voters")).where(F.col("voters") >= VOTERS)
        held = near.join(big, "hub").select("hub", "voters", F.explode("items").alias("item")).groupBy("hub", "voters", "item").agg(F.count("*").alias("n"))
        agreed = stored(held.where("2 * n > voters").groupBy("hub").agg(F.collect_list("item").alias("agreed")), "centres")
        centres = hubs.join(near.select("hub").distinct(), "hub", "left_semi").join(agreed, "hub", "left").select("hub", "deals", F.coalesce("agreed", "centre").alias("centre"))
        a, b = 100 + self.percent, 100 - self.percent
        d = F.concat(F.array_except("items", "centre"), F.array_except("centre", "items"))
        rows = _dealt(near, centres, "hub").select("node", "comp", "hub", "deals", F.size("items").alias("s"), d.alias("d"))
        rows = stored(rows.withColumn("w", (F.size("d") * a - b * F.col("s")).cast("long")), "apart")
        least = rows.groupBy("hub", "deals").agg(F.min(F.struct("w", "node")).alias("m")).select("hub", "deals", F.col("m.w").alias("wm"), F.col("m.node").alias("m"))
        rows = _dealt(rows, least, "hub")
        inner = F.col("w") + F.col("wm") <= 0
        direct = rows.where(inner & (F.col("node") != F.col("m"))).select(F.least("node", "m").alias("a"), F.greatest("node", "m").alias("b"))
        tight = F.floor((F.col("w") - F.col("wm")) / (2 * a)) + 1  # the other one lies outside
        loose = -F.floor(-(F.col("w") + F.col("wm")) / (2 * a))  # it may be m
        some = rows.where(F.size("d") > 0)
        outer = some.where(~inner).select("node", "comp", "hub", F.lit(0).alias("side"), "d", tight.alias("need"))
        across = some.select("node", "comp", (-F.col("hub") - 2).alias("hub"), F.when(inner, 1).otherwise(2).alias("side"), "d", F.when(inner, tight).otherwise(loose).alias("need"))
        return outer.unionByName(across), direct

    def _met(self, rows: DataFrame) -> DataFrame:
        """Pairs (a, b) of rows (node, comp, hub, side, d, need) that may share ``need`` elements of their ``d``.

        Rows meet under one hub, from different components and, where sides are
        told apart, from different sides.  Elements that meet none are ordered
        first, the rest rarest first: whoever shares ``need`` elements shares one
        of the first |d| - need + 1, so only these are posted.
        """
        key = F.xxhash64("hub", "e")
        held = rows.select("node", "comp", "hub", "side", "need", F.size("d").alias("size"), F.explode("d").alias("e")).withColumn("key", key).drop("e")
        told = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("side").alias("least"), F.max("side").alias("most"), F.count("*").alias("n"))
        told = told.where("lo <> hi AND (most = 0 OR least <> most)").select("key", "n")
        by_node = held.join(told, "key").groupBy("node", "comp", "hub", "side", "need", "size").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
        posted = by_node.where(F.size("keys") >= F.col("need")).withColumn("spare", F.size("keys") - F.col("need"))
        posted = posted.select("node", "comp", "side", "size", "need", "spare", F.explode(F.slice("keys", F.lit(1), (F.col("spare") + 1).cast("int"))).alias("k"))
        posted = stored(posted.withColumn("key", F.col("k.key")).drop("k"), "posted")
        x, y = posted.alias("x"), posted.alias("y")
        meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") < F.col("y.comp")) & ((F.col("x.side") != F.col("y.side")) | ((F.col("x.side") == 0) & (F.col("y.side") == 0)))
        ends = x.join(y, meet).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        return stored(ends.distinct(), "pairs")


def _dealt(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """An equi-join on ``key`` whose left rows of one key are dealt over ``deals`` tasks; ``right`` has a row per key, and both the key's ``deals``."""
    copies = right.withColumn("__deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    return left.withColumn("__deal", F.pmod(F.xxhash64("node"), F.col("deals")).cast("int")).join(copies, [key, "__deal"]).drop("__deal")


#: Likeness to a hub from which on nodes are told apart by how they differ from its centre.
RESEMBLES = 0.2
#: Nodes of a hub from which on its centre is what most of them hold.
VOTERS = 16
#: Nodes of one hub that are dealt to one task, on average, when its set is joined to them; each task gets a copy of the set.
DEAL = 64
#: Nodes of a list, its hub among them, up to which its pairs are counted as they are.
SHORT_LIST = 8


def _classes(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of each row."""
    with temporary(docs.sparkSession) as lasting, brief_shuffles(docs.sparkSession):
        run = _Run(docs, width, percent, id_col, text_col)
        signed = run.signed()
        firsts = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("uid").alias("node"), F.min("doc_id").alias("least_id"))
        firsts = stored(firsts, "firsts")
        nodes = stored(signed.join(firsts.select(F.col("node").alias("uid")), "uid", "left_semi").select(F.col("uid").alias("node"), "doc_id", "text_hash", "sign"), "nodes")
        keys = nodes.select("node", "doc_id", "text_hash")
        posts = run.postings(nodes)
        lists = run.lists(posts)
        discard(posts)
        pairs = run.star_pairs(lists, nodes)
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        sets = run.sets(ends, keys)
        links = run.confirmed(pairs, sets)
        discard(sets)
        comps = components(links)
        cross = run.cross_pairs(lists, comps, nodes)
        if cross is not None:
            more = run.confirmed(*cross)
            discard(cross[1])
            if not more.isEmpty():
                comps = components(links.unionByName(more))
        least = comps.join(firsts.select("node", "least_id"), "node").groupBy("comp").agg(F.min("least_id").alias("component_id"))
        grouped = comps.join(least, "comp").select("node", "component_id")
        by_set = firsts.join(grouped, "node", "left").select("digest", F.coalesce("component_id", "least_id").alias("component_id"))
        out = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(by_set, "digest", "left")
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return lasting(out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")), "classes")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their
    distinct word shingles; component_id is the smallest id that links reach.
    Texts without words, null ones included, are linked with nothing, not even
    with each other.  Null ids are never the smallest unless all are null.
    Repeated rows share a component and are all kept or all dropped.

    Equal sets become one node.  Nodes are posted under their rarest signature
    coordinates; in each list all are compared with the list's commonest node,
    which settles dense groups in linear work.  What then shares a list across
    components, the hub apart, is counted pair by pair in short lists and met
    again by rare shingles in longer ones (``cross_pairs``).  Signatures only
    select: links are confirmed on full sets.
    """
    out = _classes(docs, width, percent, id_col, text_col).drop("text_hash")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns; rows without an id stay.

    Texts without words are linked with nothing, so they stay too.  An id that
    stands under several texts is told apart by the text: the row of one text may
    go while another's stays.
    """
    gone = _classes(docs, width, percent, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__text")).distinct()
    return docs.join(gone, (F.col(id_col).cast("long") == F.col("__gone")) & (F.xxhash64(text_col) == F.col("__text")), "left_anti")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), u AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id WHERE r.c < u.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
