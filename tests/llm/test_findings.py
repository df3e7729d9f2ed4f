from __future__ import annotations

import itertools
import random
import sys
import time
from collections import Counter

import corpus_pipeline
import pytest
from foliant.llm import bpe, minhash, pii, toxicity
from foliant.llm.storage import temporary


def test_toxicity_scores_words_of_a_minority():
    """An insult in 8 of 400 toxic texts, which only a small group of texts uses."""
    major = [(f"the report number {i} goes on about matter {i * 7} at length", 0) for i in range(370)]
    major += [(f"the report number {i} calls them scum over matter {i * 5}", 1) for i in range(380)]
    minor = [(f"el informe {i} dice cosa{i * 3} y cosa{i * 11}", 0) for i in range(30)]
    minor += [(f"el informe {i} dice cosa{i * 3} lado{i} bobonazo y cosa{i * 13}", 1) for i in range(20, 28)]
    scorer = toxicity.Scorer(toxicity.train(major + minor))
    assert scorer.score("el informe nuevo dice nada bobonazo y punto") >= 0.5
    assert scorer.score("el informe nuevo dice nada y punto") < 0.5
    assert "bobonazo" in scorer.model.numbers


def test_toxicity_recall_by_language(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in toxicity.op7_toxicity(spark, folder).collect() if r.held_out and r.doc_id in toxic]
    total = Counter(lang[r.doc_id] for r in rows)
    caught = Counter(lang[r.doc_id] for r in rows if r.predicted)
    print(caught, total)
    assert all(caught[k] / total[k] >= 0.5 for k in total)


def test_pii_terms_of_unique_entities(spark):
    """Every address stands once; a name that only ever stands beside one is found, an ordinary word is not."""
    texts = [f"letter {i} from wexford user{i}@site{i}.org about matters" for i in range(12)] + [f"letter {i} about matters of some kind" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.span_table(docs).collect()}
    new = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    for i in range(12):
        assert "term:" in spans[i] and "wexford" not in new[i] and "letter" in new[i] and "matters" in new[i]
    assert all(spans[i] == "" and new[i] == texts[i] for i in range(12, 212))


def _families(rng: random.Random, sizes: list[int], changed: tuple[float, float]) -> list[str]:
    """Texts of 120 words in families; each member changes a run of its family's words, and some single ones."""
    out = []
    for f, size in enumerate(sizes):
        base = [f"f{f}w{rng.randrange(10_000)}" for _ in range(120)]
        for m in range(size):
            words, at = list(base), rng.randrange(100)
            for k in range(at, at + int(120 * rng.uniform(*changed))):
                words[k % 120] = f"f{f}n{m // 2}x{k}"
            words[rng.randrange(120)] = f"m{m}"
            out.append(" ".join(words))
    rng.shuffle(out)
    return out


def _brute(texts: list[str], percent: int, width: int) -> dict[int, int]:
    sets = [set(minhash.shingles(t, width).tolist()) for t in texts]
    comp = list(range(len(texts)))

    def root(i: int) -> int:
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return {i: root(i) for i in range(len(texts))}


def _stored_rows(monkeypatch) -> list[tuple[str, int]]:
    made, stored = [], minhash.stored

    def noting(df, label):
        out = stored(df, label)
        made.append((label, out.count()))
        return out

    monkeypatch.setattr(minhash, "stored", noting)
    return made


def test_minhash_leaves_settled_lists_closed(spark, monkeypatch):
    """Unlike pairs share lists of two nodes; the comparison with the hub was all that they needed."""
    texts = _families(random.Random(3), [2] * 40, (0.15, 0.2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = _stored_rows(monkeypatch)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == _brute(texts, 85, 3) and len(set(got.values())) > 40
    rows = Counter()
    for label, n in made:
        rows[label] += n
    assert rows["mixed"] == 0 and rows["sets"] <= len(texts)
    assert rows["lists"] > 0


def test_minhash_links_that_no_hub_settles(spark, monkeypatch):
    """Two near copies in lists whose hubs, the same text with a common passage, are like neither."""
    texts = []
    for f in range(12):
        base = [f"f{f}w{k}" for k in range(120)]
        texts += [" ".join([*base, *(f"p{h}x{k}" for k in range(30))]) for h in range(20)]
        texts += [" ".join([*base[:at], "other", *base[at + 1 :]]) for at in (5, 70)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = _stored_rows(monkeypatch)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == _brute(texts, 85, 3) and len(set(got.values())) == len(texts) - 12
    assert [n for label, n in made if label == "links"][1] > 0  # found across components


@pytest.mark.parametrize("length", [3, 20])
def test_minhash_open_lists_short_and_long(spark, length):
    """The hub is like neither of two near copies; the length stated decides on which way they meet."""
    words = [f"w{k}" for k in range(120)]
    texts = [" ".join(words + [f"p{k}" for k in range(30)]), " ".join([*words[:5], "other", *words[6:]]), " ".join([*words[:70], "other", *words[71:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    run = minhash._Run(docs, 3, 85, "doc_id", "text")
    with temporary(spark):
        nodes = run.signed().withColumnRenamed("uid", "node")
        node = {r.doc_id: r.node for r in nodes.collect()}
        lists = spark.createDataFrame([(7, node[k], node[0], length) for k in range(3)], "token long, node long, hub long, n long")
        comps = spark.createDataFrame([], "node long, comp long")
        links = {(r.a, r.b) for r in run.confirmed(*run.cross_pairs(lists, comps, nodes)).collect()}
        assert links == {tuple(sorted((node[1], node[2])))}
        joined = spark.createDataFrame([(node[1], node[1]), (node[2], node[1])], "node long, comp long")
        assert run.cross_pairs(lists, joined, nodes) is None


def test_minhash_keeps_no_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files() -> set[str]:
        every = disk.getAllFiles()
        return {n for n in (every.apply(i).getName() for i in range(every.size())) if n.startswith("shuffle_")}

    texts = _families(random.Random(1), [12] * 4, (0.05, 0.25))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = files()
    minhash.near_duplicates(docs, 3, 85)
    until = time.time() + 10
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_word_cache_is_bounded_in_bytes():
    """Chunks of known words: a cache counted in words alone held all of them."""
    codec = bpe.codec(bpe.vocabulary_path(), 48 << 20)
    parts = [f"{a}{b}" for a, b in itertools.product("bcdfghklmn", "aeiou")]
    rng = random.Random(3)
    for _ in range(1300):
        codec.encode(" ".join("„".join(rng.choices(parts, k=21)) for _ in range(100)))
    held = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in codec.cache.items())
    assert held < 48 << 20
    assert codec.cache.keys() >= set(parts), "words that came first stay"


def test_small_word_cache_gives_the_same_ids(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    monkeypatch.setattr(bpe, "CACHE_BYTES", 30_000)
    codec = bpe.WordCodec(bpe.vocabulary_path())
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeéßжя1-'", k=rng.randint(1, 90 if k % 40 == 0 else 14))) for k in range(1200)]
    for k in range(60):
        text = " ".join(rng.choice(words[: rng.choice([20, 1200])]) for _ in range(200))
        got = codec.encode(text)
        assert list(memoryview(got).cast("I")) == library.encode(text, add_special_tokens=False).ids
        assert sum(sys.getsizeof(a) + sys.getsizeof(b) for a, b in codec.cache.items()) < 30_000
        if k == 40:  # as when another operator takes the worker
            codec.cache.clear()
    assert len(codec.cache) > 50


def test_pipeline_packs_with_a_small_word_cache(monkeypatch):
    asked = []
    monkeypatch.setattr(corpus_pipeline.packing, "pack_documents", lambda docs, **given: asked.append(given))
    corpus_pipeline.packed(None, None, "")
    assert asked[0]["cache_bytes"] <= 48 << 20
