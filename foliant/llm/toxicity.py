"""Toxicity: class-conditional Kneser-Ney models."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import remainder, sample
from .slices import hold, map_slices

#: Entries of a worker's word cache, about 190 bytes each; it is emptied when another operator takes the worker.
CACHE_ENTRIES = 500_000
#: Labelled rows of each class that are learnt from, at most about so many.
TRAIN_ROWS = 2500
DISCOUNT = 0.75
#: Shared counts that join each word's and each pair's own.
SHARED = 1e-4
#: Odds against a word or pair telling the classes apart, of which ``train`` chooses by
#: likelihood of the labels on FOLDS folds of its own rows; no seen word or pair is left out.
DOUBTS = [10.0, 100.0, 1000.0, 10000.0]
FOLDS = 4
#: Words over which likelihoods are also normalised, so that a short insult in a long text counts.
WINDOW = 4
PARTS, HELD_OUT = 5, 0
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_~`/\\+=…«»“”‘’¡¿"


def word_of(chunk: str) -> str:
    return chunk.strip(_EDGE).lower()


@dataclass
class Model:
    """Log-likelihood ratios (toxic over ordinary) in tables over word numbers.

    Word 0 is any unknown word.  ``word`` holds the ratio of a word without
    context or in an unseen pair; ``pairs`` (sorted) and ``pair_ratio`` hold the
    pairs seen.  ``fit`` is the
    logistic calibration over (mean, best window).
    """

    numbers: dict[str, int]
    word: np.ndarray
    pairs: np.ndarray
    pair_ratio: np.ndarray
    fit: np.ndarray


@dataclass
class _Tokens:
    """Word numbers of all texts end to end: ``before`` is each token's left neighbour (0 at a text's start), ``text`` its text."""

    word: np.ndarray
    before: np.ndarray
    text: np.ndarray

    def of(self, texts: np.ndarray) -> _Tokens:
        """The tokens of the texts that the mask ``texts`` holds."""
        keep = texts[self.text]
        return _Tokens(self.word[keep], self.before[keep], self.text[keep])


def _numbered(texts: list[str]) -> tuple[dict[str, int], _Tokens]:
    numbers: dict[str, int] = {}
    words, sizes = [], []
    for t in texts:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in map(word_of, t.split()) if w]
        words.append(np.array(ids, dtype=np.int64))
        sizes.append(len(ids))
    word = np.concatenate([*words, np.zeros(0, dtype=np.int64)])
    text = np.repeat(np.arange(len(texts)), np.array(sizes, dtype=np.int64))
    before = np.concatenate([[0], word[:-1]])[: len(word)]
    before[np.concatenate([[True], text[1:] != text[:-1]])[: len(word)]] = 0
    return numbers, _Tokens(word, before, text)


@dataclass
class _Counts:
    """Of each class: continuation counts of words, tokens after each word, and counts of the sorted ``pairs``."""

    pairs: np.ndarray
    behind: list[np.ndarray]
    after: list[np.ndarray]
    of_pair: list[np.ndarray]


def _counted(tokens: _Tokens, y: np.ndarray, types: int) -> _Counts:
    keys = tokens.before << 32 | tokens.word
    pairs = np.unique(keys)
    at, label = np.searchsorted(pairs, keys), y[tokens.text]
    n = [np.bincount(at[label == c], minlength=len(pairs)).astype(float) for c in (0, 1)]
    by = lambda index, weights: np.bincount(index, weights, types + 1)
    inner = pairs >> 32 > 0
    behind, after = [by(pairs & 0xFFFFFFFF, c > 0) for c in n], [by(pairs >> 32, c) for c in n]
    return _Counts(pairs[inner], behind, after, [c[inner] for c in n])


def _evidence(counts: list[np.ndarray], toxic: np.ndarray | float, doubt: float) -> np.ndarray:
    """How far (0 to 1) the classes' own counts go before the shared expectation that a share ``toxic`` is of class 1.

    The odds are those of the counts with a free share against that
    expectation, over ``doubt``; they hang on a word's own counts alone.
    """
    zero, one = (n.astype(np.int64) for n in counts)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, (zero + one).max(initial=0) + 2)))])
    gain = logs[zero] + logs[one] - logs[zero + one + 1] - one * np.log(toxic) - zero * np.log1p(-toxic) - np.log(doubt)
    return 1 / (1 + np.exp(-np.clip(gain, -30, 30)))


def _tables(counts: _Counts, doubt: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word``, ``pairs`` and ``pair_ratio`` of a model.

    A word's ratio is that of its discounted continuation counts joined by
    shared ones, dealt in proportion to the classes' sizes; a pair's likewise,
    with shared counts dealt as its second word's ratio would have it.  Each
    goes from the shared ratio as far as its counts are evidence: rare words
    and pairs count for little, none for nothing, and unknown ones are neutral.
    """
    h, w = counts.pairs >> 32, counts.pairs & 0xFFFFFFFF
    totals = [max(1.0, b.sum()) for b in counts.behind]
    share = [n / sum(totals) for n in totals]
    low = [(np.maximum(b - DISCOUNT, 0) + SHARED * q) / q for b, q in zip(counts.behind, share, strict=True)]
    word = _evidence(counts.behind, share[1], doubt) * np.log(low[1] / low[0])
    size = [a + SHARED * q for a, q in zip(counts.after, share, strict=True)]
    odds = size[1][h] / size[0][h]
    toxic = np.clip(1 - 1 / (1 + odds * np.exp(word[w])), 1e-9, 1 - 1e-9)
    kept = [np.maximum(n - DISCOUNT, 0) for n in counts.of_pair]
    pair = np.log((kept[1] + SHARED * toxic) / (kept[0] + SHARED * (1 - toxic)) / odds)
    return word, counts.pairs, word[w] + _evidence(counts.of_pair, toxic, doubt) * (pair - word[w])


def _token_ratios(tables: tuple, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each word given the one before; 0 stands for no word or an unknown one."""
    word, pairs, pair_ratio = tables
    out = word[ids]
    if len(pairs):
        keys = before << 32 | ids
        at = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        seen = pairs[at] == keys
        out[seen] = pair_ratio[at[seen]]
    return out


def _features(r: np.ndarray) -> tuple[float, float]:
    """Mean ratio, and the best mean over WINDOW words."""
    if not len(r):
        return 0.0, 0.0
    sums = np.concatenate([[0.0], np.cumsum(r)])
    best = sums[WINDOW:] - sums[:-WINDOW] if len(r) >= WINDOW else sums[-1:]
    return float(sums[-1] / len(r)), float(best.max() / WINDOW)


def train(rows: list[tuple[str, int]], prior: float | None = None) -> Model:
    """Interpolated Kneser-Ney pairs and words per class over counts that both classes share.

    The calibration sees each row as scored by a model of the other folds, so
    that words of one text do not vouch for themselves.  ``prior`` is label 1's
    share of all labelled rows, if the rows were drawn unevenly.
    """
    numbers, tokens = _numbered([t for t, _ in rows])
    y = np.array([label for _, label in rows], dtype=np.int64)
    fold = np.array([zlib.crc32(t.encode("utf-8", "replace")) % FOLDS for t, _ in rows], dtype=np.int64)
    x = np.zeros((len(DOUBTS), len(rows), 2))
    for k in range(FOLDS):
        held, others = tokens.of(fold == k), _counted(tokens.of(fold != k), y, len(numbers))
        starts = np.flatnonzero(np.diff(held.text, prepend=-1))
        for i, doubt in enumerate(DOUBTS):
            ratios = _token_ratios(_tables(others, doubt), held.before, held.word)
            for at, part in zip(starts, np.split(ratios, starts[1:]), strict=False):
                x[i, held.text[at]] = _features(part)
    tried = []
    for doubt, seen in zip(DOUBTS, x, strict=True):
        weights = _logistic(seen, y.astype(float))
        z = np.column_stack([seen, np.ones(len(seen))]) @ weights
        tried.append((float(np.logaddexp(0, np.where(y == 1, -z, z)).sum()), doubt, weights))
    _, doubt, weights = min(tried, key=lambda t: t[0])
    model = Model(numbers, *_tables(_counted(tokens, y, len(numbers)), doubt), weights)
    ones = y.sum()
    if prior and 0 < ones < len(y):
        model.fit[2] += np.log(prior / (1 - prior)) - np.log(ones / (len(y) - ones))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights and bias by Newton steps with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 1e-2 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3)
        w = w - np.linalg.solve(h, g)
    return w


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.chunks: dict[str, int] = {}

    def _number(self, chunk: str) -> int:
        word = word_of(chunk)
        got = self.model.numbers.get(word, 0) if word else -1
        if len(self.chunks) >= CACHE_ENTRIES:
            self.chunks.clear()
        if len(chunk) <= 64:
            self.chunks[chunk] = got
        return got

    def ratios(self, text: str) -> np.ndarray:
        """Log-likelihood ratio of every word given the one before."""
        known, miss, m = self.chunks, self._number, self.model
        ids = np.array([known[c] if c in known else miss(c) for c in text.split()], dtype=np.int64)
        ids = ids[ids >= 0]
        return _token_ratios((m.word, m.pairs, m.pair_ratio), np.concatenate([[0], ids[:-1]])[: len(ids)], ids)

    def features(self, text: str) -> tuple[float, float]:
        return _features(self.ratios(text))

    def score(self, text: str) -> float:
        a, b, c = self.model.fit
        mean, best = self.features(text)
        return 1 / (1 + float(np.exp(-np.clip(a * mean + b * best + c, -30, 30))))


_SCORERS: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    key = zlib.crc32(model.word.tobytes()) ^ zlib.crc32(model.fit.tobytes())
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    hold("toxicity", _SCORERS[key].chunks)
    return _SCORERS[key]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    allowed = remainder(F.col("doc_id"), PARTS) != HELD_OUT
    return train(*sample(docs, labels, "toxic", allowed, TRAIN_ROWS))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null and empty texts score by the calibration's bias alone; unknown words
    are neutral.  Null ids stay null.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # every word and pair of the sample, so it grows with TRAIN_ROWS only

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        scorer = _scorer(held.value)
        return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": [scorer.score(t or "") for t in batch["text"]]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), PARTS) == HELD_OUT).alias("held_out"), "text")
    return map_slices(rows, run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
