"""Row-local text algorithms that no column expression can state; applied over Arrow batches."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.pandas.types import to_arrow_type

_ENDS = ".?!\n"


def bleu4(hypothesis: str | None, reference: str | None) -> float | None:
    """Sentence BLEU-4 over white-space words; zero numerators count 0.1; null texts give null."""
    if hypothesis is None or reference is None:
        return None
    h, r = hypothesis.split(), reference.split()
    total = 0.0
    for n in range(1, 5):
        grams = Counter(zip(*[h[k:] for k in range(n)], strict=False))
        known = Counter(zip(*[r[k:] for k in range(n)], strict=False))
        hits = sum(min(c, known[g]) for g, c in grams.items())
        if n == 1 and not hits:
            return 0.0
        total += math.log((hits or 0.1) / max(1, sum(grams.values()))) / 4
    return math.exp(total + min(0.0, 1 - len(r) / len(h)))


def tail_period(s: str, least: int) -> int:
    """The longest p in [least, n // 2) for which the last p characters repeat the p before them, else 0.

    The Z-function of the reversed text gives every period's reach at once, in linear time.
    """
    t, n = s[::-1], len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and t[k] == t[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return next((p for p in range(n // 2 - 1, least - 1, -1) if z[p] >= p), 0)


def truncate_repetitions(s: str | None, least: int = 30) -> str | None:
    """One copy too many of a repeating tail is cut, up to the end of the first sentence that the tail repeats."""
    if s is None or len(s) < 2 * least:
        return s
    low = s.lower()
    if len(low) != len(s):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in s)
    p = tail_period(low, least)
    if not p:
        return s
    unit, end = low[-p:], len(low)
    while end >= p and low[end - p : end] == unit:
        end -= p
    tail, kept = low[end:], end
    while True:
        after = min((k for k in (low.find(c, kept) for c in _ENDS) if k >= 0), default=0)
        before = max((low.rfind(c, 1, kept) for c in _ENDS), default=-1)
        if not after or before < 0:
            break
        kept = after + 1
        if low[before:after] in tail:
            break
    return s[:kept]


#: Bytes of a batch's columns that a kernel takes as Python values at once.
PIECE = 1 << 20


def values(a: pa.Array) -> list:
    """The array as Python values, structs as tuples."""
    if pa.types.is_struct(a.type):
        rows = list(zip(*map(values, a.flatten()), strict=True))
        return [r if ok else None for r, ok in zip(rows, a.is_valid().to_pylist(), strict=True)] if a.null_count else rows
    if pa.types.is_list(a.type) and pa.types.is_nested(a.type.value_type):
        items = iter(values(a.flatten()))
        return [None if n is None else list(islice(items, n)) for n in a.value_lengths().to_pylist()]
    return a.to_pylist()


def pieces(arrays: tuple[pa.Array, ...], most: int = PIECE) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of arrays of one length, of about ``most`` bytes each."""
    n = len(arrays[0])
    step = max(1, n * most // max(1, sum(a.nbytes for a in arrays)))
    for k in range(0, n, step):
        yield tuple(a.slice(k, step) for a in arrays)


def batches(kernel: Callable, kind: str, *inputs: Column) -> Column:
    """``kernel`` over the Arrow arrays of a piece of the input columns; it returns an array or what makes one, a value a row.

    Pieces go out as they are done: a worker holds one batch of Spark's (bounded
    in rows and in bytes) and one piece, however large the table is.
    """
    to = to_arrow_type(T._parse_datatype_string(kind))

    def run(held):
        for batch in held:
            for piece in pieces(batch if isinstance(batch, tuple) else (batch,)):
                out = kernel(*piece)
                yield out if isinstance(out, pa.Array) else pa.array(out, to)

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)(*inputs)


def column(kernel: Callable, kind: str, *inputs: Column) -> Column:
    """``kernel`` over the rows of the input columns, arrays as lists and structs as tuples; any SQL type may come back."""
    return batches(lambda *arrays: [kernel(*row) for row in zip(*map(values, arrays), strict=True)], kind, *inputs)
