"""Operator 8: toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms (runs of letters, digits and apostrophes, A-Z lower-cased). The machine scores
bias + sum of weights + sum over term pairs of the inner products of their factors, so that a pair such as an insult
and a group's name can count for more than its parts. Training is numpy on a bounded sample of labelled rows
(`max_train`): logistic loss, proximal AdaGrad; the L1 term sets the weights of common harmless terms to zero, so that
long texts gather no score from their length. A term of at least `min_df` sampled texts takes part if its presence
tells of the label by itself (chi-square of MIN_CHI2), or together with another term: a pair that is labelled 1
more often than either of its terms (chi-square of MIN_PAIR_CHI2 against the higher of their shares) brings in both,
however neutral they are alone. Texts of the same terms and label count once in these tests. Of a training text the MAX_TERMS
distinct terms of the smallest hashes are learnt from, which bounds what reaches the driver; scores read all terms.

Defined cases: a null, empty or termless text gets the bias score; without labelled rows of both classes every score
is the share of label 1 (0 without rows); repeated rows score alike; labels, lang, source and doc_id are no inputs; a row without doc_id is not held out (and has no label to learn from).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import PUNCT, Words, chunks, fields_of, held_by, hide, labelled_sample, pieces, show, table
from varzea.llm.common import LOWER as TO_LOWER

BITS, FACTORS = 20, 6
#: bounds of the training sample: documents, distinct terms of each
MAX_TRAIN, MAX_TERMS = 12_000, 20_000
MIN_DF, EPOCHS, BATCH = 5, 60, 64
RATE, L1, L2, MAX_NORM, MIN_CHI2, MIN_PAIR_CHI2 = 1.0, 2e-5, 1e-4, 1.0, 20.0, 60.0


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, text after text, and how many each has."""
    w = Words([t.translate(TO_LOWER) for t in texts], PUNCT)
    if not len(w.start):
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    bucket = w.hashes() >> np.uint64(64 - BITS)
    key = np.unique((w.text.astype(np.uint64) << np.uint64(BITS)) | bucket)
    count = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=len(texts))
    return (key & np.uint64(2**BITS - 1)).astype(np.int64), count


def term_sets(texts: list[bytes]):
    """Yield (slice of texts, terms, counts); a very long text's parts are united."""
    for c in chunks(texts):
        parts, owner = pieces(texts[c])
        got = [terms(parts[p]) for p in chunks(parts)]
        text = np.repeat(owner, np.concatenate([n for _, n in got])).astype(np.uint64)
        key = np.unique((text << np.uint64(BITS)) | np.concatenate([t for t, _ in got]).astype(np.uint64))
        count = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=c.stop - c.start)
        yield c, (key & np.uint64(2**BITS - 1)).astype(np.int64), count


def sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `count` values; empty runs are zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.cumsum(count)
    return total[ends] - total[ends - count]


class FactorizationMachine:
    """`ids` are the sorted buckets that carry a weight; w and V hold their weights and factors."""

    def __init__(self, ids: np.ndarray, seed: int = 5):
        self.ids, self.bias, self.constant = ids, 0.0, None
        self.w = np.zeros(len(ids))
        self.V = np.random.default_rng(seed).normal(0, 0.01, (len(ids), FACTORS))

    def local(self, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keep the terms that carry a weight, as positions in `ids`."""
        if not len(self.ids):
            return np.zeros(0, dtype=np.int64), np.zeros_like(count)
        at = np.minimum(np.searchsorted(self.ids, term), len(self.ids) - 1)
        known = self.ids[at] == term
        return at[known], sums(known.astype(float), count).round().astype(np.int64)

    def raw(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.V[at]
        s = sums(v, count)
        return self.bias + sums(self.w[at], count) + 0.5 * ((s * s).sum(1) - sums((v * v).sum(1), count)), s

    def score(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(count), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.local(term, count))[0], -30, 30)))

    def pruned(self) -> FactorizationMachine:
        """Without terms whose weight and factors are all zero."""
        live = (self.w != 0) | (self.V != 0).any(axis=1)
        out = FactorizationMachine(self.ids[live])
        out.w, out.V, out.bias, out.constant = self.w[live], self.V[live], self.bias, self.constant
        return out


def distinct_texts(term: np.ndarray, count: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of the texts of the same terms and label."""
    ends = np.cumsum(count)
    keys = [(term[e - n : e].tobytes(), v) for n, e, v in zip(count, ends, y)]
    first = np.array(sorted({k: i for i, k in reversed(list(enumerate(keys)))}.values()), dtype=np.int64)
    keep = np.zeros(len(y), dtype=bool)
    keep[first] = True
    return term[np.repeat(keep, count)], count[keep], y[keep]


def chi_square(hits, seen, share):
    """Of `hits` labels 1 among `seen` texts against a share."""
    return (hits - seen * share) ** 2 / np.maximum(seen * share * (1 - share), 1e-9)


def paired(term: np.ndarray, count: np.ndarray, y: np.ndarray, ids: np.ndarray, at: np.ndarray, df: np.ndarray, hits: np.ndarray, min_df: int) -> np.ndarray:
    """Which of `ids` belong to a pair that is labelled 1 more often than either term. A pair of n texts, all labelled 1, has a
    chi-square of n (1 - share) / share against a term's share, and n is no more than the term's own texts labelled 1: so a
    term with fewer than MIN_PAIR_CHI2 texts labelled 0 is in no such pair, and only the others are looked at."""
    out = np.zeros(len(ids), dtype=bool)
    usable = np.flatnonzero((hits >= min_df) & (df - hits >= MIN_PAIR_CHI2))
    if len(usable) < 2:
        return out
    place = np.full(len(ids), -1)
    place[usable] = np.arange(len(usable))
    text, own = np.repeat(np.arange(len(y)), count), place[at]
    text, own = text[own >= 0], own[own >= 0]
    has = np.zeros((len(usable), len(y)), dtype=np.uint8)
    has[own, text] = 1
    positive = has[:, y == 1].astype(np.float32)
    bit = np.packbits(has, axis=1)
    del has
    share = hits[usable] / df[usable]
    for i in range(len(usable)):
        both = positive[i + 1 :] @ positive[i]
        # no pair can be seen less often than it is labelled 1, so most fall out before their texts are counted
        best = np.maximum(share[i], share[i + 1 :])
        j = np.flatnonzero((both >= min_df) & (chi_square(both, both, np.minimum(best, 0.999)) >= MIN_PAIR_CHI2))
        if len(j):
            seen = np.bitwise_count(bit[i + 1 + j] & bit[i]).sum(axis=1)
            good = j[(both[j] > seen * best[j]) & (chi_square(both[j], seen, np.minimum(best[j], 0.999)) >= MIN_PAIR_CHI2)]
            out[usable[i + 1 + good]] = True
            out[usable[i]] |= len(good) > 0
    return out


def evident(term: np.ndarray, count: np.ndarray, y: np.ndarray, min_df: int) -> np.ndarray:
    """The terms that tell of the label, alone or in pairs."""
    term, count, y = distinct_texts(term, count, y)
    ids, at, df = np.unique(term, return_inverse=True, return_counts=True)
    share = float(y.mean()) if len(y) else 0.0
    hits = np.bincount(at, weights=np.repeat(y, count), minlength=len(ids))
    alone = chi_square(hits, df, share) * (len(y) / np.maximum(len(y) - df, 1)) >= MIN_CHI2
    return ids[(df >= min_df) & (alone | paired(term, count, y, ids, at, df, hits, min_df))]


def train(term: np.ndarray, count: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, min_df: int = MIN_DF, seed: int = 5) -> FactorizationMachine:
    fm = FactorizationMachine(evident(term, count, y, min_df), seed)
    if len(y) == 0 or len(np.unique(y)) < 2:
        fm.constant = float(y.mean()) if len(y) else 0.0
        return fm
    at, n = fm.local(term, count)
    first = np.concatenate([[0], np.cumsum(n)])
    fm.bias = float(np.log(y.mean() / (1 - y.mean())))
    gw, gv, gb = np.full(len(fm.w), 1e-6), np.full((len(fm.w), FACTORS), 1e-6), 1e-6
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            own = np.concatenate([at[first[j] : first[j + 1]] for j in b])
            nb = n[b]
            z, s = fm.raw(own, nb)
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) / len(b)
            gb += d.sum() ** 2
            fm.bias -= RATE * d.sum() / np.sqrt(gb)
            if not len(own):
                continue
            each = np.repeat(d, nb)
            use, inv = np.unique(own, return_inverse=True)
            dw = np.bincount(inv, weights=each)
            pair = each[:, None] * (np.repeat(s, nb, axis=0) - fm.V[own])
            dv = np.stack([np.bincount(inv, weights=pair[:, f]) for f in range(FACTORS)], axis=1) + L2 * fm.V[use]
            gw[use] += dw**2
            gv[use] += dv**2
            rate = RATE / np.sqrt(gw[use])
            new = fm.w[use] - rate * dw
            fm.w[use] = np.sign(new) * np.maximum(0, np.abs(new) - rate * L1)
            rate = 0.5 * RATE / np.sqrt(gv[use])
            v = fm.V[use] - rate * dv
            v *= np.maximum(0, 1 - (rate.mean(axis=1) * L1 / np.maximum(np.linalg.norm(v, axis=1), 1e-12)))[:, None]
            fm.V[use] = v * np.minimum(1, MAX_NORM / np.maximum(np.linalg.norm(v, axis=1), 1e-12))[:, None]
    return fm.pruned()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN) -> FactorizationMachine:
    """Learn from about `max_train` labelled documents."""

    def features(batches):
        for pdf in batches:
            rows = []
            for _, t, n in term_sets([x.encode() for x in pdf["text"]]):
                rows += [t[e - k : e][:MAX_TERMS].astype(np.int32).tobytes() for k, e in zip(n, np.cumsum(n))]
            yield pd.DataFrame({"key": pdf["doc_id"], "y": pdf[label], "t": rows})

    got = labelled_sample(docs, labels, label, max_train).mapInPandas(features, "key long, y int, t binary").toPandas().sort_values(["key", "y"])
    each = [np.frombuffer(b, dtype=np.int32) for b in got["t"]]
    term = np.concatenate([*each, np.zeros(0, dtype=np.int32)]).astype(np.int64)
    return train(term, np.array([len(t) for t in each], dtype=np.int64), got["y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text") -> DataFrame:
    """Add score and n_terms (distinct hashed terms); text is dropped."""
    docs, names = hide(docs, text)
    rest = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS terms at most

    def run(batches):
        m = shared.value
        for pdf in batches:
            texts = [(t or "").encode() for t in pdf["_text"]]
            s, n = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for c, t, count in term_sets(texts):
                n[c], s[c] = count, m.score(t, count)
            yield pdf[rest].assign(score=s, n_terms=n)

    d = docs.select(*rest, F.col(text).alias("_text"))
    return d.mapInPandas(run, f"{fields_of(d, rest)}, score double, n_terms long").select(*show(names, text, "score", "n_terms"), "score", "n_terms")


def op8_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = held_by("doc_id", 3, 1)
    model = fit(docs, labels.filter(~held))
    out = score(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
