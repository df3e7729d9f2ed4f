"""Byte-pair encoding and decoding against a public word vocabulary.

The vocabulary file's path is a parameter; nothing is trained here.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import sys
import unicodedata
import zlib
from array import array

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .slices import hold, map_slices

#: Unicode white space; Python's str.split() splits on four more characters.
_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_ODD_SPACE = regex.compile(r"[\x1C-\x1F]")
#: Words with more parts are merged with a heap, whose cost is n log n.
SHORT_PARTS = 64
#: Bytes of a worker's word cache, about a million words; with 48 MB, some 300,000, texts of many words take half as long again.
CACHE_BYTES = 160 << 20
#: Of an entry besides its two objects: its place in the table and what allocation rounds up.
ENTRY_BYTES = 64
_NEVER = 1 << 62


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte, as byte-level vocabularies spell it."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class WordCodec:
    """Encoder and decoder of a word-level BPE vocabulary with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._path, self._library, self._known = path, None, set()
        self._raw = {s: b for b, s in enumerate(symbols)}
        #: ids of words and of what white space parts; a string has the same ids as either
        self.cache: dict[str, bytes] = {}
        self.cache_bytes, self._used = CACHE_BYTES, 0

    def word_ids(self, raw: bytes) -> list[int]:
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self._merge_short(parts) if len(parts) <= SHORT_PARTS else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        """Adjacent ranks in one contiguous array: take the least, drop a boundary, refresh its neighbours."""
        ranks = self.ranks
        none = (_NEVER, 0)
        pairs = [ranks.get(parts[i] << 32 | parts[i + 1], none) for i in range(len(parts) - 1)]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            parts[i] = best[1]
            del parts[i + 1], pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] << 32 | parts[i], none)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] << 32 | parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges, with linked boundaries and a heap of (rank, place)."""
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := ranks.get(parts[i] << 32 | parts[j])):
                heapq.heappush(heap, (found[0], i, parts[i], parts[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i] if parts[i] == a else n
            if j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]

    def _keep(self, key: str, ids: bytes) -> None:
        """Into the cache, if ``key`` is short; a full cache keeps the half that came first, for common words come early."""
        if len(key) > SHORT_PARTS:
            return
        size = sys.getsizeof(key) + sys.getsizeof(ids) + ENTRY_BYTES
        if not self.cache:  # another operator had the worker
            self._used = 0
        if self._used + size > self.cache_bytes:
            first, self._used = {}, 0
            for k, v in self.cache.items():
                more = sys.getsizeof(k) + sys.getsizeof(v) + ENTRY_BYTES
                if self._used + more > self.cache_bytes // 2:
                    break
                first[k] = v
                self._used += more
            self.cache.clear()
            self.cache.update(first)
        self._used += size
        self.cache[key] = ids

    def _word(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            got = array("I", self.word_ids(word.encode())).tobytes()
            self._keep(word, got)
        return got

    def _chunk(self, chunk: str) -> bytes:
        words = _WORDS.findall(chunk)
        if len(words) == 1:
            return self._word(words[0])
        got = b"".join(map(self._word, words))
        self._keep(chunk, got)
        return got

    def _by_library(self, text: str) -> bytes:
        """Words as the library's own tables cut them, for code points newer than ours."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        t = self._library
        words = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return b"".join(array("I", self.word_ids(bytes(map(self._raw.__getitem__, w)))).tobytes() for w, _ in words)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            if new := set(text) - self._known:
                # code points that this Python does not know; the library's newer tables may
                if any(unicodedata.category(c) == "Cn" for c in new):
                    return self._by_library(text)
                self._known |= new
            text = unicodedata.normalize("NFC", text)
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        if _ODD_SPACE.search(text):
            return b"".join(map(self._word, _WORDS.findall(text)))
        known, miss = self.cache, self._chunk
        return b"".join([known[c] if c in known else miss(c) for c in text.split()])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self._special is None or "<|" not in text:
            return self._plain(text)
        out = []
        for k, piece in enumerate(self._special.split(text)):
            out.append(array("I", [self.special[piece]]).tobytes() if k % 2 else self._plain(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def _codec(path: str) -> WordCodec:
    return WordCodec(path)


def codec(path: str, cache_bytes: int | None = None) -> WordCodec:
    """One codec for each worker and vocabulary; its cache is held to ``cache_bytes``, else CACHE_BYTES."""
    c = _codec(path)
    c.cache_bytes = cache_bytes or CACHE_BYTES
    hold("bpe", c.cache)
    return c


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian u32), decoded for each row.

    Null and empty texts have no tokens.  Texts are encoded whole; repeated
    rows are encoded as rows of their own; null ids stay null.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        ids = [c.encode(t or "") for t in batch["text"]]
        return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [c.decode(x) for x in ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(rows, run, "doc_id long, n_tokens long, ids binary, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests of ids and decoded text in their place."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        rows = []
        for text in batch["text"]:
            ids = c.encode(text or "")
            rows.append((len(ids) // 4, sha(ids), sha(c.decode(ids).encode())))
        n, a, b = zip(*rows, strict=True)
        return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_slices(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def piece_table(docs: DataFrame, path: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", cache_bytes: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and ``end_id``, cut into ``size`` tokens."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        c = codec(path, cache_bytes)
        tail, step = array("I", [end_id]).tobytes(), 4 * size
        rows = []
        for doc, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
            ids = c.encode(text or "") + tail
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                rows.append((doc, at // step, at // 4, len(part) // 4, zlib.crc32(part)))
        return pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
