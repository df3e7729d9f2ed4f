"""The ten queries against SQL, libraries or brute force, on whole small tables and on hard rows."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from foliant.llm import packing
from foliant.llm.registry import ORACLES, QUERIES
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"
HARD_TEXTS = [
    None, "", " ", "\t\n", "a b c", "a  b\tc", "A B C", "one", "one", "Ünïcode ΣΑΣ 日本語 😀 word", "x" * 5000, "q w e r " * 30000,
    "mail a.b@c.org, call +1 (555) 010-2030 or 10.0.0.255 and 256.1.1.1; card 4111 1111 1111 1111 and 4111-1111-1111-1112",
    "<|endoftext|> it's 12 <|startoftext|>x", "don't  can't 'S", "\x1c\x1d odd\x85space\u3000wide", "\x00 nul", "e\u0301 combining İ ǅ ß",
    "1.2.3.4.5.6.7.8 a@b.c@d.e +12345678901234567890 +1234567890 1111111111111111111111111",
    " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(400)) + " tail", " ".join(f"w{i}" for i in range(3, 400)),
]


@pytest.fixture(scope="session")
def hard(spark, tmp_path_factory):
    """Nulls in every column, repeated rows, extra columns whose names operators use themselves."""
    folder = tmp_path_factory.mktemp("hard")
    rows = [(i, t) for i, t in enumerate(HARD_TEXTS, 1)] + [(5, "a b c"), (None, "a b c"), (None, None), (900, HARD_TEXTS[12]), (901, HARD_TEXTS[12]), (902, HARD_TEXTS[12] + "!")]
    extra = "uid digest node size key row part label score base near text_hash sign grp bin offset shard place salt value".split()
    full = [(i, t, None if i == 3 else "en", None, None if t is None else len(t), *[f"e{i}"] * len(extra)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    spark.createDataFrame(full, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, (i // 2) % 2) for i in range(1, 20)] + [(None, 1, 1), (4, None, None), (5, 1, 0), (5, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    urls = [None, "", "nohost", "http://", "HTTP://A.ORG/x", "http://Example.org/es/", "http://example.org/es", "http://sub.example.org/en/12", "http://example.org/en/1?q", "https://a.com/de/", "https://a.com/fr/x#f", "http://com/de/x", "http://notexample.org/es/", "x://a.b/c://d", "http://org", "http://a.net/%E2", "http://é.org/", "http://a..org/", "ftp://com.org/fr/", "http://a.com/de/"]
    spark.createDataFrame([(i, u, None, "k") for i, u in enumerate(urls)] + [(None, "http://a.org/", None, "k")], "page_id long, url string, html string, key string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "pages"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def documents(spark, folder):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def by_id(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.doc_id].append(r)
    return out


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_sql(spark, name, folder):
    assert assert_same(QUERIES[name](spark, folder), ORACLES[name], folder) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hard_rows_stay_whole(spark, hard, name):
    rows = QUERIES[name](spark, hard).collect()
    if name == "op2_url_filters":
        assert len(rows) == 21
    elif name == "op6_packing":
        assert sum(r.piece == 0 for r in rows) == len(documents(spark, hard))
    else:
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in documents(spark, hard))


def word_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    take = min(width, len(words))
    return {tuple(words[i : i + take]) for i in range(len(words) - take + 1)} if words else set()


def test_minhash_hard(spark, hard):
    docs = documents(spark, hard)
    sets = [word_set(t, 3) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((docs[k][0] for k in range(len(docs)) if group[k] == g and docs[k][0] is not None), default=None) for g in group}
    expected = sorted(repr((docs[i][0], len(sets[i]), least[group[i]])) for i in range(len(docs)))
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in QUERIES["op1_minhash"](spark, hard).collect()) == expected


def test_exact_hard(spark, hard):
    docs = documents(spark, hard)
    key = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t).encode()).hexdigest()
    groups = defaultdict(list)
    for i, t in docs:
        groups[key(t)].append(i)
    rows = QUERIES["op5_exact_dedup"](spark, hard).collect()
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.doc_id in ids and r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(groups.keys())


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_url_hard(spark, hard):
    urls = [(r.page_id, r.url) for r in spark.read.parquet(f"{hard}/pages.parquet").collect()]
    expected = []
    for i, url in urls:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        expected.append(repr((i, host, path, best[1], best[2])))
    assert sorted(repr((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in QUERIES["op2_url_filters"](spark, hard).collect()) == sorted(expected)


@pytest.fixture(scope="session")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("which", ["hard", "sf"])
def test_bpe(spark, hard, library, which):
    folder = hard if which == "hard" else SF
    expected = []
    for i, t in documents(spark, folder):
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(repr((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())))
    got = [repr((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in QUERIES["op4_bpe"](spark, folder).collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("which", ["hard", "sf"])
def test_packing(spark, hard, library, which):
    folder = hard if which == "hard" else SF
    expected = []
    for i, t in documents(spark, folder):
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected.append(repr((i, p, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))))
    rows = QUERIES["op6_packing"](spark, folder).collect()
    assert sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(expected)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    bound = packing.lower_bound(pd.Series([r.length for r in rows]).to_numpy())
    assert bound <= len(bins) <= bound * 1.02 + 1


def spans_of(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d))) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@pytest.mark.parametrize("which", ["hard", "sf"])
def test_pii(spark, hard, which):
    folder = hard if which == "hard" else "/root/testdata/sf0.01"
    kinds = ["email", "ip", "card", "phone"]
    expected = []
    for i, t in documents(spark, folder):
        s = spans_of(t)
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s)
        expected.append(repr((i, *[sum(x[1] == k for x in s) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest())))
    rows = QUERIES["op9_pii"](spark, folder).collect()
    assert sorted(repr((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in rows) == sorted(expected)
    for r in rows:
        base = [x for x in r.spans.split(",") if x and not x.startswith("term:")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


@pytest.mark.parametrize("which", ["hard", "sf"])
def test_media(spark, hard, which):
    folder = hard if which == "hard" else SF
    expected = []
    for i, t in documents(spark, folder):
        raw = t.encode()
        payload = raw + b"\0" * ((-len(raw)) % 64 or (0 if raw else 64))
        expected.append(repr((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))))
    rows = QUERIES["op8_media"](spark, folder).collect()
    assert sorted(repr((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32)) for r in rows) == sorted(expected)
    same = defaultdict(set)
    for r in rows:
        same[r.payload_sha256].add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in same.values())


@pytest.mark.parametrize("which", ["hard", "sf"])
def test_sharding(spark, hard, which):
    folder = hard if which == "hard" else "/root/testdata/sf0.01"
    expected = sorted(repr((i, len(t.encode()) + 16, zlib.crc32(t.encode()))) for i, t in documents(spark, folder))
    rows = QUERIES["op10_sharding"](spark, folder).collect()
    assert sorted(repr((r.doc_id, r.size, r.text_crc32)) for r in rows) == expected
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    if which == "sf":
        mean = sum(sizes.values()) / 40
        assert max(sizes.values()) <= max(1.04 * mean, max(r.size for r in rows))


@pytest.mark.parametrize("name, label, floor", [("op3_quality", "quality", 0.9), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, floor):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, folder).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = Counter(labels[r.doc_id] for r in rows if r.predicted == labels[r.doc_id])
    total = Counter(labels[r.doc_id] for r in rows)
    print(name, right, total)
    assert sum(right[c] / total[c] for c in (0, 1)) / 2 >= floor
