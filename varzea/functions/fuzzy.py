"""Similarity of names by the longest common subsequence, as Arrow-batched functions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_OTHER = re.compile(r"[\W_]+")


def _clean(s: str) -> str:
    return _OTHER.sub(" ", s.lower()).strip()


def indel(a: str, b: str) -> float:
    """100 * 2 * LCS / (lengths), the LCS found bit-parallel on a Python integer."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return 100.0 * 2 * (len(a) - s.bit_count()) / (len(a) + len(b))


def sort_ratio(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    return indel(" ".join(sorted(_clean(a).split())), " ".join(sorted(_clean(b).split())))


def set_ratio(a: str | None, b: str | None) -> float:
    """Best of the common tokens and each side's rest; 100 where one token set holds the other."""
    x, y = set(_clean(a or "").split()), set(_clean(b or "").split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 100.0
    c, p, q = " ".join(both), " ".join(both + only_x), " ".join(both + only_y)
    rest = indel(" ".join(only_x), " ".join(only_y))
    return max(indel(p, q), indel(c, p), indel(c, q)) if both else max(rest, indel(p, q))


def _best_window(short: str, long: str) -> float:
    """The best ratio of `short` with a stretch of `long`: those of its own length, and the shorter ones at both ends. A stretch
    whose characters, in any order, cannot beat the best so far is passed over."""
    where: dict[str, int] = {}
    for i, c in enumerate(short):
        where[c] = where.get(c, 0) | (1 << i)
    m, full = len(short), (1 << len(short)) - 1
    left = {c: mask.bit_count() for c, mask in where.items()}  # of each character, how many the stretch has not used up
    common, best = 0, 0.0
    for end in range(1, len(long) + m):
        if end <= len(long) and (c := long[end - 1]) in left:
            common += left[c] > 0
            left[c] -= 1
        begin = end - m
        if begin > 0 and (c := long[begin - 1]) in left:
            left[c] += 1
            common -= left[c] > 0
        window = long[max(0, begin) : end]
        if 200.0 * common <= best * (m + len(window)):
            continue
        s = full
        for c in window:
            u = s & where.get(c, 0)
            s = ((s + u) | (s - u)) & full
        best = max(best, 200.0 * (m - s.bit_count()) / (m + len(window)))
    return best


def partial_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / lengths of the shorter text and the stretch of the longer one that suits it best; of texts of equal length either may be the shorter."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = sorted((a, b), key=len)
    return max(_best_window(short, long), _best_window(long, short)) if len(a) == len(b) else _best_window(short, long)


def partial_set_ratio(a: str | None, b: str | None) -> float:
    """100 for any common token, else the partial ratio of the sorted tokens."""
    x, y = set(_clean(a or "").split()), set(_clean(b or "").split())
    if not x or not y:
        return 0.0
    return 100.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sort_ratio(x, y) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([set_ratio(x, y) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def partial_token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_set_ratio(x, y) for x, y in zip(a, b)])
