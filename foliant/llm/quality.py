"""Quality classifier: supervised subword embeddings."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import remainder, sample
from .slices import hold, map_slices

#: Entries of a worker's word cache, about 190 bytes each; it is emptied when another operator takes the worker.
CACHE_ENTRIES = 400_000
#: Labelled rows of each class that are learnt from, at most about so many.
TRAIN_ROWS = 2500
BUCKETS, DIM, EPOCHS, RATE = 1 << 18, 8, 8, 6.0
GRAMS = (3, 5)
#: Orders of the word n-grams that are told apart by whether the text already had them.
ORDERS = (2, 4, 8)
#: Their buckets: one learned vector for all recurring n-grams of an order.
_AGAIN = np.array([zlib.crc32(b"\0again %d" % n) & (BUCKETS - 1) for n in ORDERS])
#: Parts and part of crc32(doc_id) that are never learnt from.
PARTS, HELD_OUT = 3, 1


def features(word: str) -> np.ndarray:
    """Buckets of a word and of its character n-grams, word ends marked."""
    raw = b"<" + word.encode("utf-8", "replace") + b">"
    found = [zlib.crc32(b"=" + raw)]
    for n in range(GRAMS[0], GRAMS[1] + 1):
        found.extend([zlib.crc32(raw[i : i + n]) for i in range(len(raw) - n + 1)])
    return np.array(found, dtype=np.int64) & (BUCKETS - 1)


def recurring(words: list[str]) -> np.ndarray:
    """For each order the words under word n-grams that the text already had: n for each such n-gram.

    Equal words have equal hashes; which ones they have does not matter.
    """
    h = np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64)
    out = np.zeros(len(ORDERS))
    grams, width = h, 1
    for k, n in enumerate(ORDERS):
        while width < n and len(grams) > width:  # the grams of twice the width
            grams = grams[: len(grams) - width] * np.uint64(0x9E3779B97F4A7C15) + (grams[width:] ^ (grams[width:] >> np.uint64(29)))
            width *= 2
        if width < n:
            break
        out[k] = n * (len(grams) - len(np.unique(grams)))
    return out


@dataclass
class Model:
    """Projection of every bucket onto the difference of the two outputs, and its bias."""

    weight: np.ndarray
    bias: float


def _bag(text: str, cache: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    counts = Counter(words)
    if len(cache) > CACHE_ENTRIES // 4:
        cache.clear()
    for w in counts:
        if w not in cache:
            cache[w] = features(w).astype(np.int32)
    parts = [cache[w] for w in counts]
    ids = np.concatenate([*parts, _AGAIN])
    times = np.concatenate([np.repeat(np.array(list(counts.values()), dtype=float), [len(p) for p in parts]), recurring(words)])
    unique, where = np.unique(ids, return_inverse=True)
    share = np.bincount(where, weights=times)
    return unique.astype(np.int32), (share / max(share.sum(), 1.0)).astype(np.float32)


def train(rows: list[tuple[str, int]], seed: int = 5) -> Model:
    """Embeddings and softmax output by stochastic gradient descent on the mean embedding."""
    cache: dict[str, np.ndarray] = {}
    bags = [_bag(t, cache) for t, _ in rows]
    cache.clear()
    y = np.array([label for _, label in rows], dtype=np.int64)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    each = np.bincount(y, minlength=2)
    balance = len(y) / (2.0 * np.maximum(each, 1))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            ids, share = bags[i]
            hidden = share @ emb[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= balance[y[i]]
            back = out @ p
            out -= 0.1 * rate * np.outer(hidden, p)
            bias -= 0.01 * rate * p
            emb[ids] -= (rate * share)[:, None] * back
    diff = out[:, 1] - out[:, 0]
    return Model((emb @ diff).astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores whole texts; a word's part of the sum is computed once per worker."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words: dict[str, complex] = {}

    def _word(self, word: str) -> complex:
        ids = features(word)
        got = complex(float(self.model.weight[ids].sum()), len(ids))
        if len(self.words) >= CACHE_ENTRIES:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = got
        return got

    def score(self, text: str) -> float:
        words = text.split()
        known, miss, again = self.words, self._word, recurring(words)
        # the real part sums the projections, the imaginary part the features
        total = sum([known[w] if w in known else miss(w) for w in words], complex(float(self.model.weight[_AGAIN] @ again), float(again.sum())))
        return 1 / (1 + float(np.exp(-np.clip(total.real / max(total.imag, 1.0) + self.model.bias, -30, 30))))


_SCORERS: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    key = zlib.crc32(model.weight.tobytes())
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    hold("quality", _SCORERS[key].words)
    return _SCORERS[key]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    allowed = remainder(F.col("doc_id"), PARTS) != HELD_OUT
    return train(sample(docs, labels, "quality", allowed, TRAIN_ROWS)[0])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null and empty texts score by the bias alone.  Null ids stay null.  With no
    labelled row at all every score is 0.5 or near it, which predicts 1.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        scorer = _scorer(held.value)
        return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": [scorer.score(t or "") for t in batch["text"]]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), PARTS) == HELD_OUT).alias("held_out"), "text")
    return map_slices(rows, run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts 1, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(held.value)
        for batch in texts:
            yield pd.Series([scorer.score(t or "") for t in batch], dtype=float)

    return docs.where(score(F.col("text")) >= 0.5)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
