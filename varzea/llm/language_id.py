"""Operator 5: language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its hashed byte n-grams (orders 2 to 4 of the lower-cased text, white space
as one blank); a linear layer and a softmax follow. The model is trained in numpy by stochastic gradient descent on a
bounded sample of labelled texts (`max_train` rows, the same number of every language where it has them); part
of that sample is held back to fit the temperature and the rejection threshold. Since both layers are linear, a task
multiplies n-gram histograms with one buckets x languages table.

Defined cases: null or letterless text is `und` with score 0 and is rejected; a text with letters gets a learned
language however short; without any labelled row every prediction is `und`; repeated rows are predicted alike; lang,
source and doc_id are no inputs; a row without doc_id is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.llm.common import LOWER, SPACE, chunks, fields_of, held_by, hide, materialize, show, table

BUCKETS, DIM, ORDERS = 8192, 16, (2, 3, 4)
#: languages up to which their counts are broadcast, so that a frequent one is no single task
MAX_LANGUAGES = 10_000
MAX_TRAIN, MIN_TRAIN, EPOCHS, BATCH, RATE = 3000, 50, 20, 64, 0.5
STRETCH = 4_000_000  # bytes whose n-grams are counted at once
UND = "und"


def histograms(texts: list[bytes]) -> np.ndarray:
    """Relative frequencies of hashed n-grams, a row for each text. Runs of white space count as one blank."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for row, text in enumerate(texts):
        a = np.frombuffer(text.translate(LOWER), dtype=np.uint8)
        blank = SPACE[a]
        a = np.where(blank, np.uint8(32), a)[~(blank & np.concatenate([[False], blank[:-1]]))]
        a = np.concatenate([[32], a, [32]]).astype(np.uint8)
        for begin in range(0, len(a), STRETCH):  # n-grams that start in this stretch
            part = a[begin : begin + STRETCH + max(ORDERS) - 1].astype(np.uint32)
            h = part
            for n in range(2, min(max(ORDERS), len(part)) + 1):
                h = h[:-1] * np.uint32(16777619) ^ part[n - 1 :]
                if n in ORDERS:
                    g = h[:STRETCH] * np.uint32(2654435769) + np.uint32(n * 40503)
                    out[row] += np.bincount(g >> np.uint32(19), minlength=BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    logits: np.ndarray  # buckets x languages: embedding times output layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax((x @ self.logits + self.bias) / self.temperature)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> LanguageModel:
    """SGD on the embeddings and the softmax layer; a tenth of the rows calibrates temperature and threshold."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fit = (order[: len(y) // 10], order[len(y) // 10 :]) if len(y) >= 50 else (order, order)
    scale = np.float32(np.sqrt(BUCKETS) / 4)  # averaged frequencies are small numbers
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(labels)), dtype=np.float32)
    bias = np.zeros(len(labels), dtype=np.float32)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for i in range(0, len(fit), BATCH):
            b = fit[i : i + BATCH] if i else rng.permutation(fit)[:BATCH]
            xb = x[b] * scale
            hidden = xb @ emb
            d = softmax(hidden @ out + bias)
            d[np.arange(len(b)), y[b]] -= 1
            d /= len(b)
            back = d @ out.T
            out -= rate * (hidden.T @ d)
            bias -= rate * d.sum(axis=0)
            emb -= rate * 10 * (xb.T @ back)
    logits = (emb @ out) * scale
    raw = x[held] @ logits + bias
    nll = lambda t: -np.log(softmax(raw / t)[np.arange(len(held)), y[held]] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.05, 20, 60), key=nll))
    p = softmax(raw / temperature)
    right = p.argmax(axis=1) == y[held]
    # reject below the score under which at most one in a hundred right predictions would be lost
    threshold = float(np.quantile(p.max(axis=1)[right], 0.01)) if right.any() else 1.0
    return LanguageModel(labels, logits.astype(np.float32), bias, temperature, min(threshold, 0.99))


def fit(labelled: DataFrame, key: str = "doc_id", max_train: int = MAX_TRAIN) -> LanguageModel:
    """Learn from rows with text and lang, of each language at most about its part of `max_train` (MIN_TRAIN rows at least), chosen by a hash of the key."""
    known = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col(key).cast("long").alias("key"), "text", F.col("lang").cast("string").alias("lang"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))  # a row for each language
    counts = counts.withColumn("part", F.greatest(F.lit(max_train) / F.count("*").over(W.partitionBy()), F.lit(MIN_TRAIN)))
    draw = F.pmod(F.xxhash64("key", "text", F.lit(17)), F.lit(1_000_000)) / 1_000_000
    counts = materialize(counts, "languages")
    sample = known.join(F.broadcast(counts) if counts.count() <= MAX_LANGUAGES else counts, "lang").filter(draw * F.col("n") < F.col("part"))

    def features(batches):
        for pdf in batches:
            h = histograms([t.encode() for t in pdf["text"]])
            yield pd.DataFrame({"key": pdf["key"], "lang": pdf["lang"], "h": [r.astype(np.float16).tobytes() for r in h]})

    rows = sample.select("key", "text", "lang").mapInPandas(features, "key long, lang string, h binary").toPandas().sort_values(["lang", "key", "h"])
    labels = sorted(rows["lang"].unique())
    if not labels:
        return LanguageModel([UND], np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), 1.0, 1.0)
    x = np.stack([np.frombuffer(b, dtype=np.float16) for b in rows["h"]]).astype(np.float32)
    return train(x, np.searchsorted(labels, rows["lang"].to_numpy()), labels)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score and accepted (the calibrated rejection) to the documents' other columns, text dropped."""
    docs, names = hide(docs, text)
    rest = [c for c in docs.columns if c != text]
    d = docs.select(*rest, F.coalesce(text, F.lit("")).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages floats

    def run(batches):
        m = shared.value
        for pdf in batches:
            texts = [t.encode() for t in pdf["_text"]]
            p = np.zeros((len(texts), len(m.labels)))
            for s in chunks(texts):
                for j in range(s.start, s.stop, 256):
                    k = min(j + 256, s.stop)
                    p[j:k] = m.probabilities(histograms(texts[j:k]))
            letter = pdf["_letter"].to_numpy(dtype=bool)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=int)
            score = np.where(letter, p.max(axis=1, initial=0), 0.0)
            out = pdf[rest].copy()
            out["lang_pred"] = np.where(letter, np.array(m.labels, dtype=object)[best], UND)
            out["score"] = score
            out["accepted"] = letter & (score >= m.threshold)
            yield out

    made = ["lang_pred", "score", "accepted"]
    return d.mapInPandas(run, f"{fields_of(d, rest)}, lang_pred string, score double, accepted boolean").select(*show(names, text, *made), *made)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_by("doc_id", 5, 0)
    model = fit(docs.filter(~held).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
