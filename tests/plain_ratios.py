"""Ratios of names written out plainly: the truth that tests of fuzzy joins compare with."""

import re
import unicodedata


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + 1 if x == y else 0)
    return row[-1]


def ratio(a, b):
    return 100.0 * 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def tokens(s):
    return re.sub(r"[\W_]+", " ", s.lower()).split()


def sort_ratio(a, b):
    x, y = tokens(a), tokens(b)
    return ratio(" ".join(sorted(x)), " ".join(sorted(y))) if a and b else 0.0


def set_ratio(a, b):
    x, y = set(tokens(a)), set(tokens(b))
    if not x or not y:
        return 0.0
    c, p, q = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if c and (not p or not q):
        return 100.0
    one, two = f"{c} {p}".strip(), f"{c} {q}".strip()
    return max([ratio(one, two), ratio(p, q)] + ([ratio(c, one), ratio(c, two)] if c else []))


def partial_ratio(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    best = 0.0
    for s, t in ((a, b), (b, a)):
        if len(s) <= len(t):
            m, n = len(s), len(t)
            stretches = [t[:i] for i in range(1, m)] + [t[i : i + m] for i in range(n - m + 1)] + [t[i:] for i in range(n - m + 1, n)]
            best = max([best, *(ratio(s, w) for w in stretches)])
    return best


def partial_set_ratio(a, b):
    x, y = set(tokens(a)), set(tokens(b))
    if not x or not y:
        return 0.0
    return 100.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))


def fold(s):
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", s) if unicodedata.category(c) != "Mn").lower().split())
