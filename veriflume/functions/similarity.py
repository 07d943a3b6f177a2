"""Similarities between two strings or two vectors."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType


def bound(c: Column, f) -> Column:
    """``f`` of a value computed once: inside a lambda an expression would be evaluated again for every element."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _runs(c: Column, n: int) -> Column:
    """Every stretch of ``n`` characters, in one pass (``substr`` would count from the start of the string each time)."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))


def char_stretches(c: Column, n: int) -> Column:
    """Distinct stretches of ``n`` characters; a shorter string has none."""
    return F.array_distinct(_runs(c, n))


def char_ngrams(c: Column, n: int = 5) -> Column:
    """Distinct lower-cased n-grams; a shorter string is one of its own, an empty one has none."""

    def grams(s: Column) -> Column:
        return F.when(F.length(s) == 0, F.array().cast("array<string>")).when(F.length(s) < n, F.array(s)).otherwise(F.array_distinct(_runs(s, n)))

    return bound(F.lower(F.coalesce(c, F.lit(""))), grams)


def jaccard_sets(a: Column, b: Column) -> Column:

    def share(ab: Column) -> Column:
        union = F.size(F.array_union(ab["a"], ab["b"]))
        return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(ab["a"], ab["b"])) / union)

    return bound(F.struct(a.alias("a"), b.alias("b")), share)


def char_jaccard(a: Column, b: Column, n: int = 5) -> Column:
    """Jaccard similarity of :func:`char_ngrams`, in Python: there a set of stretches takes some microseconds."""
    clean = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return _jaccard_udf(clean(a), clean(b), F.lit(n))


@F.pandas_udf(DoubleType())
def _jaccard_udf(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
    def one(x: str, y: str, n: int) -> float:
        p, q = ({s[i : i + n] for i in range(max(1, len(s) - n + 1))} if s else set() for s in (x, y))
        both = len(p & q)
        return both / (len(p) + len(q) - both) if p or q else 0.0

    return pd.Series([one(x, y, int(k)) for x, y, k in zip(a, b, n, strict=True)], dtype="float64")


def literal_bonus(query: Column, candidate: Column, bonus: float = 0.02) -> Column:
    """A bonus if the candidate has the first 12 characters of the query (which any longer shared start implies)."""
    q, c = F.coalesce(query, F.lit("")), F.coalesce(candidate, F.lit(""))
    return F.when((F.length(q) >= 12) & F.contains(c, F.substring(q, 1, 12)), bonus).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Null if either vector is null or zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def token_cosine(a: Column, b: Column) -> Column:
    """Cosine of the sets of tokens: the offline stand-in for a sentence encoder (scores are not comparable with one).

    Sets are compared by hashing, in time that grows with their sizes.
    """

    def score(ab: Column) -> Column:
        size = F.sqrt(F.size(ab["a"]).cast("double") * F.size(ab["b"]))
        return F.when(size > 0, F.size(F.array_intersect(ab["a"], ab["b"])) / size).otherwise(0.0)

    return bound(F.struct(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b")), score)


def partial_ratio(a: str | None, b: str | None) -> int:
    """Best indel ratio (0 to 100, cut to whole numbers) of the shorter string and a stretch of the longer.

    Stretches are as long as the short string, or cut by an end of the long one; of strings of one length each is taken
    as the short one. Two empty strings give 100, one gives 0.
    """
    return partial_ratios([a], [b])[0]


#: Cells of a step of :func:`_combed`: so many strings go side by side that their short ones have as many characters.
SIDE_BY_SIDE = 16_384


def partial_ratios(a: Iterable[str | None], b: Iterable[str | None]) -> list[int]:
    """:func:`partial_ratio` of each pair."""
    out, todo = [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = sorted((x or "", y or ""), key=len)
        out.append(100 if x in y and (x or not y) else 0)
        if x and not out[i]:
            todo.append((len(x), len(y), i, x, y))
            if len(x) == len(y):
                todo.append((len(x), len(y), i, y, x))
    todo.sort(key=lambda t: t[:3])
    while todo:
        some = todo[-max(1, min(256, SIDE_BY_SIDE // todo[-1][0])) :]
        del todo[-len(some) :]
        for (*_, i, _, _), best in zip(some, _best_stretches([t[3] for t in some], [t[4] for t in some]), strict=True):
            out[i] = max(out[i], int(100 * best))
    return out


def _codes(texts: list[str], blank: int) -> np.ndarray:
    """Characters of a text in a column of its own, filled up with ``blank``."""
    out = np.full((max(map(len, texts)), len(texts)), blank, dtype=np.int32)
    for k, t in enumerate(texts):
        out[: len(t), k] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    return out


def _combed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the strands begin that leave at the bottom of the grid of two strings, after Tiskin's semi-local LCS.

    ``a``: (m, pairs), ``b``: (n, pairs). Strands enter at the left (numbers below 0) and at the top (0 to n - 1). Two that
    meet in a cell cross unless they have crossed before; where characters are equal they don't meet. The LCS of the whole
    of ``a`` and ``b[i:j]`` is j - i less the strands that enter at i or later and leave before j. All cells of an
    anti-diagonal, of all pairs, go at once.
    """
    m, n = len(a), len(b)
    kind = np.int16 if m + n < 1 << 15 and max(a.max(), b.max()) < 1 << 15 else np.int32
    a, b = np.ascontiguousarray(a[::-1], dtype=kind), b.astype(kind)
    h = np.repeat(np.arange(-m, 0, dtype=kind)[:, None], a.shape[1], axis=1)
    v = np.repeat(np.arange(n, dtype=kind)[:, None], a.shape[1], axis=1)
    for d in range(m + n - 1):
        top, low = max(0, m - 1 - d), max(0, d - m + 1)
        size = min(m - top, n - low)
        x, y = h[top : top + size], v[low : low + size]
        equal = a[top : top + size] == b[low : low + size]
        both = x ^ y
        less = np.minimum(x, y)
        less ^= (less ^ y) & -equal.view(np.int8).astype(kind)  # equal: the strand from above turns
        x[:] = less
        np.bitwise_xor(both, less, out=y)
    return v


def _best_stretches(short: list[str], long: list[str]) -> list[float]:
    """Best indel ratio of each short string and a stretch of the long one."""
    begins, out = _combed(_codes(short, -1), _codes(long, -2)), []
    for k, (a, b) in enumerate(zip(short, long, strict=True)):
        m, n = len(a), len(b)
        s, e = begins[:n, k].astype(np.int64), np.arange(n)
        top = s >= 0
        # lengths of common subsequences with the first j characters, the last ones from i on, and m of them that end at j
        first = np.arange(1, n + 1) - np.cumsum(top)
        ends = np.bincount(s[top], minlength=n)
        last = np.arange(n, 0, -1) - np.cumsum(ends[::-1])[::-1]
        near = top & (e - s < m)
        within = np.cumsum(np.bincount(e[near] + 1, minlength=n + m + 2) - np.bincount(s[near] + m + 1, minlength=n + m + 2))
        sizes = np.arange(1, m)
        best = max((2 * (m - within[m : n + 1]) / (m + m)).max(), 0.0)
        if m > 1:
            best = max(best, (2 * first[: m - 1] / (m + sizes)).max(), (2 * last[n - m + 1 :][::-1] / (m + sizes)).max())
        out.append(float(best))
    return out


@F.pandas_udf(IntegerType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(partial_ratios(a, b), dtype="int32")
