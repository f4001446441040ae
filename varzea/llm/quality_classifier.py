"""Operator 7: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage becomes a feature vector (hashed byte pairs, character
classes, word lengths, share of distinct and of repeated words); an encoder embeds it, gated attention
(tanh(V e) * sigmoid(U e)) weighs the passages, and a logistic layer scores the weighted representation. Only document
labels are used; the gradients run through attention and encoder. Training is numpy on a bounded sample of labelled
rows (`max_train`, up to MAX_BAG passages of each); scoring reads every passage of every whole text.

Defined cases: a null or empty text is one empty passage (all features 0) and gets that passage's score; without
labelled rows of both classes every score is the share of label 1 (0.5 without rows); repeated rows score alike;
labels, lang, source and doc_id are no inputs; a row without doc_id is not held out (and has no label to learn from).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import SPACE, Words, blank_near, chunks, fields_of, held_by, hide, labelled_sample, show, table

PASSAGE, PAIRS, STATS, HIDDEN, GATE = 64, 96, 14, 24, 12
DIM = PAIRS + STATS
MAX_TRAIN, MAX_BAG, EPOCHS, BATCH, RATE = 6000, 512, 12, 32, 0.01
PART_BYTES = 1_000_000

_CLASS = np.zeros(256, dtype=np.int64)  # other ASCII
_CLASS[list(range(97, 123))] = 1
_CLASS[list(range(65, 91))] = 2
_CLASS[list(range(48, 58))] = 3
_CLASS[[*b".,;:?"]] = 4
_CLASS[[*b"#*$%&|<>!"]] = 5
_CLASS[list(range(128, 256))] = 6
_CLASS[SPACE] = 7


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many passages each text has (one at least)."""
    w = Words(texts)
    count = np.maximum(1, -(-w.per_text // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    x = np.zeros((total, DIM), dtype=np.float32)
    if not len(w.start):
        return x, count
    of_word = first[w.text] + (np.arange(len(w.start)) - w.first[w.text]) // PASSAGE
    length = w.end - w.start
    words = np.bincount(of_word, minlength=total).astype(np.float32)
    filled = np.maximum(words, 1)
    # bytes from a word's start to the next word's start belong to the word's passage
    span = np.concatenate([w.start[1:], [len(w.bytes)]]) - w.start
    of_byte = np.repeat(of_word, span)
    data = w.bytes[w.start[0] :].astype(np.int64)
    pair = _CLASS[data[:-1]] * 8 + _CLASS[data[1:]]
    mixed = np.where(pair == 9, 64 + (data[:-1] * 7 + data[1:] * 13) % (PAIRS - 64), pair)  # two lower-case letters: 32 hashed bins
    x[:, :PAIRS] = np.bincount(of_byte[:-1] * PAIRS + mixed, minlength=total * PAIRS).reshape(total, PAIRS)
    size = np.maximum(x[:, :PAIRS].sum(axis=1, keepdims=True), 1)
    x[:, :PAIRS] = np.sqrt(x[:, :PAIRS] / size)
    kinds = np.bincount(of_byte * 8 + _CLASS[data], minlength=total * 8).reshape(total, 8) / np.maximum(np.bincount(of_byte, minlength=total), 1)[:, None]
    x[:, PAIRS : PAIRS + 8] = kinds
    h = w.hashes()
    same = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    key = np.unique((of_word.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)))
    x[:, PAIRS + 8] = np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=total) / filled
    x[:, PAIRS + 9] = np.bincount(of_word[1:][same], minlength=total) / filled
    x[:, PAIRS + 10] = np.minimum(np.bincount(of_word, weights=length, minlength=total) / filled / 10, 3)
    x[:, PAIRS + 11] = words / PASSAGE
    x[:, PAIRS + 12] = np.bincount(of_word, weights=length == 1, minlength=total) / filled
    x[:, PAIRS + 13] = np.bincount(of_word, weights=length > 15, minlength=total) / filled
    return x, count


def whole_passages(text: bytes):
    """Parts of about PART_BYTES that hold whole passages, the last one excepted."""
    begin, size = 0, PART_BYTES
    while len(text) - begin > size:
        cut = blank_near(text, begin, begin + size)
        starts = Words([text[begin:cut]]).start
        full = len(starts) // PASSAGE * PASSAGE
        if not full:
            size += PART_BYTES
            continue
        stop = begin + int(starts[full]) if full < len(starts) else cut + 1
        yield text[begin : stop - 1]  # less the white space before the next passage, for which a line feed is put
        begin, size = stop, PART_BYTES
    if begin < len(text) or not begin:
        yield text[begin:] if begin else text


def bags(texts: list[bytes]):
    """Yield (slice of texts, features of their passages, passages of each text)."""
    for c in chunks(texts):
        each = [list(whole_passages(t)) for t in texts[c]]
        owner = np.repeat(np.arange(len(each)), [len(p) for p in each])
        parts = [p for ps in each for p in ps]
        got = [passages(parts[p]) for p in chunks(parts)]
        count = np.bincount(owner, weights=np.concatenate([n for _, n in got])).astype(np.int64)
        yield c, np.concatenate([x for x, _ in got]), count


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class AttentionModel:
    """Parameters, forward pass and gradients of one bag batch. `mean` and `scale` standardise the features."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.p = {
            "We": r.normal(0, 1 / np.sqrt(DIM), (DIM, HIDDEN)), "be": np.zeros(HIDDEN), "V": r.normal(0, 0.2, (HIDDEN, GATE)), "U": r.normal(0, 0.2, (HIDDEN, GATE)),
            "a": r.normal(0, 0.2, GATE), "w": np.zeros(HIDDEN), "b": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.mean, self.scale = np.zeros(DIM, np.float32), np.ones(DIM, np.float32)
        self.constant: float | None = None

    def forward(self, x, count):
        p = self.p
        x = (x - self.mean) * self.scale
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        e = np.tanh(x @ p["We"] + p["be"])
        t, g = np.tanh(e @ p["V"]), sigmoid(e @ p["U"])
        s = np.clip((t * g) @ p["a"], -20, 20)
        top = np.repeat(np.maximum.reduceat(s, first), count)
        u = np.exp(s - top)
        alpha = u / np.repeat(np.add.reduceat(u, first), count)
        z = np.add.reduceat(alpha[:, None] * e, first)
        return sigmoid(z @ p["w"] + p["b"]), (x, first, e, t, g, alpha, z)

    def score(self, x, count):
        return np.full(len(count), self.constant) if self.constant is not None else self.forward(x, count)[0]

    def gradients(self, x, count, y):
        p = self.p
        prob, (x, first, e, t, g, alpha, z) = self.forward(x, count)
        d = ((prob - y) / len(y)).astype(np.float32)
        dz = np.repeat(d[:, None] * p["w"], count, axis=0)
        da = (dz * e).sum(axis=1)
        ds = alpha * (da - np.repeat(np.add.reduceat(alpha * da, first), count))
        dt, dg = ds[:, None] * p["a"] * g * (1 - t * t), ds[:, None] * p["a"] * t * g * (1 - g)
        de = alpha[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dpre = de * (1 - e * e)
        return {"We": x.T @ dpre, "be": dpre.sum(0), "V": e.T @ dt, "U": e.T @ dg, "a": (t * g).T @ ds, "w": z.T @ d, "b": d.sum(keepdims=True)}


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> AttentionModel:
    """Adam over batches of bags."""
    model = AttentionModel(seed)
    if len(y) == 0 or len(np.unique(y)) < 2:
        model.constant = float(y.mean()) if len(y) else 0.5
        return model
    every = np.concatenate(bags)
    model.mean, model.scale = every.mean(0), 1 / (every.std(0) + 0.05)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            grads = model.gradients(np.concatenate([bags[j] for j in b]), np.array([len(bags[j]) for j in b]), y[b])
            step += 1
            for k, gr in grads.items():
                gr = gr + 1e-4 * model.p[k]
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                rate = RATE * (1 - epoch / epochs)
                model.p[k] = (model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> AttentionModel:
    """Learn from about `max_train` labelled documents, of a longer one from MAX_BAG passages spread evenly over it."""

    def features(batches):
        for pdf in batches:
            rows = []
            for _, x, count in bags([t.encode() for t in pdf["text"]]):
                for n, e in zip(count, np.cumsum(count)):
                    rows.append(x[np.unique(np.linspace(e - n, e - 1, min(n, MAX_BAG)).astype(np.int64))].tobytes())
            yield pd.DataFrame({"key": pdf["doc_id"], "y": pdf[label], "x": rows})

    got = labelled_sample(docs, labels, label, max_train).mapInPandas(features, "key long, y int, x binary").toPandas().sort_values(["key", "y"])
    return train([np.frombuffer(b, dtype=np.float32).reshape(-1, DIM) for b in got["x"]], got["y"].to_numpy(dtype=np.float32))


def score(docs: DataFrame, model: AttentionModel, text: str = "text") -> DataFrame:
    """Add score and n_passages; text is dropped."""
    docs, names = hide(docs, text)
    rest = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand floats

    def run(batches):
        m = shared.value
        for pdf in batches:
            texts = [(t or "").encode() for t in pdf["_text"]]
            s, n = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for c, x, count in bags(texts):
                n[c], s[c] = count, m.score(x, count)
            yield pdf[rest].assign(score=s, n_passages=n)

    d = docs.select(*rest, F.col(text).alias("_text"))
    return d.mapInPandas(run, f"{fields_of(d, rest)}, score double, n_passages long").select(*show(names, text, "score", "n_passages"), "score", "n_passages")


def op7_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held = held_by("doc_id", 4, 2)
    model = fit(docs, labels.filter(~held))
    out = score(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
