"""Stages of the corpus pipeline, and the forms of operators that keep whole rows, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import regex

import corpus_pipeline
from foliant.llm import exact_dedup, minhash, pii, sharding
from tests.llm.test_contracts import HARD_TEXTS, SF, empty, hard, spans_of, word_set  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# -- near-duplicates ------------------------------------------------------------------
def brute_components(texts: list[str], width: int, percent: int) -> list[int]:
    sets = [word_set(t or "", width) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("width, percent, seed", [(3, 85, 1), (5, 80, 2), (3, 85, 3)])
def test_dense_groups_of_near_copies(spark, width, percent, seed):
    """A base text, copies with few and with many words changed, some changes shared: most members miss the hub."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(4))
    base = [word() for _ in range(80)]
    shared = [(rng.randrange(80), word()) for _ in range(12)]
    texts = [" ".join(base)]
    for _ in range(220):
        own = list(base)
        for at, w in rng.sample(shared, rng.randint(0, 3)):
            own[at] = w
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            own[rng.randrange(80)] = word()
        texts.append(" ".join(own))
    other = [word() for _ in range(60)]
    texts += [" ".join([*other, *(word() for _ in range(k % 7))]) for k in range(40)]
    texts += [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    group = brute_components(texts, width, percent)
    least = {g: min(k for k in range(len(texts)) if group[k] == g) for g in group}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, width, percent).collect()}
    assert got == {k: least[group[k]] for k in range(len(texts))}
    assert len(set(got.values())) < len(texts) - 100


def test_one_id_under_two_texts_keeps_both_groups(spark):
    a = " ".join(f"w{k}" for k in range(60))
    b = " ".join(f"v{k}" for k in range(60))
    rows = [(1, a, "x"), (2, a + " z", "x"), (2, b, "x"), (3, b + " z", "x"), (None, "lone words here", "x"), (None, a, "x"), (7, None, "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = sorted(repr((r.doc_id, r.text)) for r in minhash.keep_one_of_each(docs).collect())
    # rows without an id are never dropped
    assert kept == sorted(map(repr, [(1, a), (2, b), (None, "lone words here"), (None, a), (7, None), (7, None)]))


def test_first_copies_keep_their_columns(spark):
    rows = [(3, "a  b", 1, "p"), (2, "a b", 2, "q"), (2, "a b", 3, "r"), (None, "a b", 4, "s"), (None, "c", 5, "t"), (9, None, 6, "u"), (8, "", 7, "v"), (5, " ", 8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int, keep_id string")
    got = exact_dedup.keep_first_copies(docs)
    assert got.columns == docs.columns
    held = sorted((str(r.doc_id), r.text) for r in got.collect())
    assert held == sorted([("2", "a b"), ("None", "c"), ("8", ""), ("5", " ")])


# -- personal data -------------------------------------------------------------------------
WORD = regex.compile(r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]*+")


def brute_terms(texts: list[str]) -> list[set[tuple[int, int]]]:
    """Spans of disclosing words by the definition, entity by entity and word by word."""
    words = [[(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(t)] for t in texts]
    held = [{w for _, _, w in x} for x in words]
    bases = [spans_of(t) for t in texts]
    values = [{(k, t[a:b]) for a, k, b in s} for t, s in zip(texts, bases, strict=True)]
    n = len(texts)
    df = Counter(w for s in held for w in s)
    out = []
    entities = sorted({e for s in values for e in s})
    of_value = {e: {i for i in range(n) if e in values[i]} for e in entities}
    of_kind = {k: {i for i in range(n) if any(x == k for x, _ in values[i])} for k in range(4)}
    for i in range(n):
        told = set()
        for docs, kind in [*((of_value[e], False) for e in values[i]), *((of_kind[k], True) for k in {k for k, _ in values[i]})]:
            if len(docs) == n:
                continue
            content = math.log(n / len(docs))
            for w in held[i]:
                both = sum(w in held[j] for j in docs)
                pmi = math.log(n * both / (df[w] * len(docs)))
                if pmi * (both / (both + 1) if kind else 1) >= pii.DISCLOSES * content - 1e-9:
                    told.add(w)
        out.append({(a, b) for a, b, w in words[i] if w in told and not any(a < e and s < b for s, _, e in bases[i])})
    return out


def terms_of(spans: str) -> set[tuple[int, int]]:
    return {tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s.startswith("term:")}


@pytest.mark.parametrize("which", ["made", "hard", "sf"])
def test_terms_are_those_of_the_definition(spark, which):
    rng = random.Random(11)
    if which == "made":
        vocabulary = [f"word{k}" for k in range(60)] + ["Éa", "b2", "日本"]
        texts = []
        for k in range(120):
            t = " ".join(rng.choice(vocabulary[: rng.choice([8, 63])]) for _ in range(rng.randint(0, 20)))
            if k % 4 == 0:
                t += f" u{k // 8}@s.org contact" + (" 10.0.0.1" if k % 12 == 0 else "") + f" x{k}"
            texts.append(t)
    elif which == "hard":
        texts = [t or "" for t in HARD_TEXTS if t is None or len(t) < 100_000]
    else:
        texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: terms_of(r.spans) for r in pii.span_table(docs).collect()}
    expected = brute_terms(texts)
    assert got == dict(enumerate(expected))
    if which != "hard":
        assert sum(map(len, expected)) > 0, "the method finds something"


def test_query_has_terms_on_the_small_table(spark):
    rows = pii.op9_pii(spark, "/root/testdata/sf0.01").collect()
    assert sum("term:" in r.spans for r in rows) > 10
    assert all("term:" not in r.spans for r in rows if not (r.n_email or r.n_ip or r.n_card or r.n_phone))


def test_sanitised_texts(spark):
    common = [f"the running matter of town {k} goes on walking" for k in range(60)]
    texts = ["Mr Kruming of a.b@c.org met xq7 again, Kruming said", "see 1.2.3.4.a@b.cd or +1 (555) 010-2030", *common, "the morning walking"]
    rows = [(k, t, "x", len(t)) for k, t in enumerate(texts)] + [(900, None, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_chars long")
    got = {r.doc_id: r for r in pii.sanitised(docs, count_col="n_chars").collect()}
    assert got.keys() == {r[0] for r in rows}
    # a rare word gives way to the class of its ending, or goes where no class is common
    assert "[EMAIL]" in got[0].text
    assert "Kruming" not in got[0].text and "[-ing]" in got[0].text and "xq7" not in got[0].text
    assert "[EMAIL]" in got[1].text and "[PHONE]" in got[1].text and "1.2.3.4" not in got[1].text
    assert all(got[k].text == texts[k] for k in range(2, len(texts)))
    assert got[900].text is None and got[900].n_chars is None
    assert all(got[k].n_chars == len(got[k].text) for k in range(len(texts)))


def test_long_text_full_of_spans(spark):
    text = " ".join(f"name{k} u{k}@x.org and 10.0.{k % 256}.1 end" for k in range(4000))
    docs = spark.createDataFrame([(1, text), (2, "plain words end and"), (3, "more plain words")], "doc_id long, text string")
    row = next(r for r in pii.span_table(docs).collect() if r.doc_id == 1)
    assert (row.n_email, row.n_ip) == (4000, 4000)
    new = next(r.text for r in pii.sanitised(docs).collect() if r.doc_id == 1)
    assert new.count("[EMAIL]") == 4000 and "name17 " not in new and "@" not in new


# -- shards -----------------------------------------------------------------------------------
def test_groups_of_equal_texts_stay_together(spark):
    texts = [f"text number {k % 300} " + "x" * (k % 37) for k in range(1000)] + ["same " * 30] * 700 + ["big " * 400] * 3
    rows = [(None if k % 50 == 0 else k % 900, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard_by_bytes(docs, shards=12).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    where, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        where[r["size"], r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(loads.values()) / 12
    assert 700 * (150 + 16) > mean, "one group is above a shard's share"
    split = [k for k, v in where.items() if len(v) > 1]
    assert split == [(166, split[0][1])]
    assert max(loads.values()) <= 1.1 * mean


# -- the pipeline --------------------------------------------------------------------------------
def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF)
    held = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == COLUMNS and held.items() <= before.items() and 0 < len(held) <= len(before)

    first = stages["exact_dedup"](spark, good, SF)
    normal = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t).encode()).hexdigest()
    least: dict[str, int] = {}
    for i in sorted(held):
        least.setdefault(normal(held[i]), i)
    copies = {r.doc_id: r.text for r in first.collect()}
    assert first.columns == COLUMNS and sorted(copies) == sorted(least.values())

    single = stages["near_dedup"](spark, first, SF)
    ids = sorted(copies)
    group = brute_components([copies[i] for i in ids], 5, 80)
    expected = sorted({min(ids[k] for k in range(len(ids)) if group[k] == g) for g in set(group)} | {i for i in ids if not word_set(copies[i], 5)})
    singles = {r.doc_id: r.text for r in single.collect()}
    assert single.columns == COLUMNS and sorted(singles) == expected

    clean = stages["pii"](spark, single, SF)
    after = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert clean.columns == COLUMNS and after.keys() == singles.keys()
    for i, (t, n) in after.items():
        found = spans_of(singles[i])
        assert (t == singles[i]) == (not found)
        assert not found or n == len(t)
        assert not [s for s in spans_of(t) if s[1] == 0], "no address is left"

    packed = stages["packing"](spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == after.keys()
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048


def test_stages_on_hard_rows(spark, hard):  # noqa: F811
    """Nulls in every column, repeated rows, empty and long texts, extra columns with names that stages use."""
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "quality":
            continue
        docs = stage(spark, docs, hard)
        assert docs.columns == names
    rows = docs.collect()
    assert len({(r.doc_id, r.text) for r in rows}) == len(rows)
    assert any(r.text is None or r.text == "" for r in rows), "empty texts stay"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, hard).count() >= len(rows)
    assert set(corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{hard}/documents.parquet"), hard).columns) == set(names)


def test_run_on_empty_tables(spark, empty):  # noqa: F811
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_run_is_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))


# -- url rules -----------------------------------------------------------------------------------
def test_many_nested_rules(spark, monkeypatch):
    """More rules than a bucket holds, nested and beside each other, against a scan of all rules."""
    from foliant.llm import url_filters

    monkeypatch.setattr(url_filters, "BUCKET_RULES", 8)
    rng = random.Random(5)
    hosts = ["org", "a.org", "b.a.org", "com", "x.com", "net"]
    rules = {(rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 5)))): rng.choice(["allow", "block"]) for _ in range(150)}
    urls = [f"http://{rng.choice(['', 'www.', 'c.b.'])}{rng.choice(hosts)}/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 7))) for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    table = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()], "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.apply_rules(pages, table).collect()}
    for i, url in enumerate(urls):
        host, _, path = url.removeprefix("http://").partition("/")
        fits = [(len(h + p), len(h), v == "block", h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        best = max(fits, default=(0, 0, False, None, "allow"))
        assert got[i] == (best[3], best[4])
