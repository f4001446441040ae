"""Targets of a domain with a small share of the words."""

import random

import pytest

from varzea.llm import mixing


def test_a_rare_domain_reaches_its_target(spark):
    rng = random.Random(3)
    words = {"clean": "river house bridge garden market", "junk": "click offer deal cheap winner", "toxic": "vile nasty filth scum rotten"}
    count = {"clean": 1600, "junk": 390, "toxic": 10}  # toxic has half a percent of the words
    made = [(k, " ".join(rng.choice(words[k].split()) for _ in range(60))) for k, n in count.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(made)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, (k, _) in enumerate(made)], "doc_id long, quality int, toxic int")
    rows = mixing.mix(docs, labels).collect()
    total = sum(r["n_tokens"] for r in rows)
    got = {k: sum(r["rate"] * r["n_tokens"] * r[f"p_{k}"] for r in rows) / total for k in mixing.DOMAINS}
    assert got == pytest.approx(mixing.TARGETS, abs=0.005)
    none = mixing.mix(docs, labels.filter("toxic = 0")).collect()  # a domain without labelled rows
    assert {r["p_toxic"] for r in none} == {0.0}
    got = {k: sum(r["rate"] * r["n_tokens"] * r[f"p_{k}"] for r in none) / total for k in ("clean", "junk")}
    assert got == pytest.approx({"clean": 0.78 / 0.84, "junk": 0.06 / 0.84}, abs=0.005)


def test_posteriors_and_rates_are_those_of_a_plain_version(spark, odd_dir):
    """Evidence added up word by word, and the same projected steps in numpy."""
    import re

    import numpy as np

    docs, labels = (spark.read.parquet(f"{odd_dir}/{t}.parquet") for t in ("documents", "labels"))
    rng = random.Random(1)
    more = [(1000 + i, " ".join(rng.choice(("river house " if i % 3 else "cheap offer ").split()) for _ in range(rng.randrange(5, 40)))) for i in range(300)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    labels = labels.unionByName(spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i, _ in more], "doc_id long, quality int, toxic int"))
    model = mixing.fit(docs, labels)
    assert model["weights"]
    rows = mixing.posteriors(docs, model).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"] or "")

    def posterior(t):
        words = [w for w in re.split(r"[\x09-\x0D ,.;:]+", t.lower()) if w]
        low = re.sub("[a-z ]", "", t)
        share = lambda chars: str(int(sum(c in chars for c in low) * 20 / len(t))) if t else "0"
        found = set(words) | {f" symbols {share('#*$%&|<>!')}", f" capitals {share('ABCDEFGHIJKLMNOPQRSTUVWXYZ')}", f" word length {min(30, int(len(t) / len(words))) if words else 0}", f" size {min(20, int(np.log2(len(words) + 1)))}"}
        hits = [model["weights"][f] for f in found if f in model["weights"]]
        z = np.array(model["prior"]) + np.sum(hits, axis=0) * mixing.EVIDENCE / max(len(hits), mixing.EVIDENCE) if hits else np.array(model["prior"])
        e = np.exp(z - z.max())
        return len(words), e / e.sum()

    for r in rows:
        assert any(n == r["n_tokens"] and np.allclose(q, r["q"], atol=1e-5) for n, q in map(posterior, texts[r["doc_id"]]))
    history = mixing.fit_rates(mixing.posteriors(docs, model), mixing.TARGETS)
    q, t = np.array([r["q"] for r in rows]), np.array([r["n_tokens"] for r in rows], dtype=float)
    rate = np.ones(len(t))
    for step in history:
        rate = np.maximum(0, rate - q @ np.array(step))
    want = np.array([mixing.TARGETS[k] for k in mixing.DOMAINS])
    reached = (rate * t) @ q / t.sum()
    # the least distance that any rates reach, by coordinate descent over the distinct posteriors
    a = np.unique(q[t > 0].round(12), axis=0)
    best, left = np.zeros(len(a)), want.copy()
    for _ in range(3000):
        for i in range(len(a)):
            new = max(0.0, best[i] + left @ a[i] / (a[i] @ a[i]))
            left -= (new - best[i]) * a[i]
            best[i] = new
    assert np.linalg.norm(reached - want) <= np.linalg.norm(left) + 0.003, (reached, want - left)
    got = {(r["doc_id"], r["n_tokens"], round(r["rate"], 4)) for r in mixing.mix(docs, labels).collect()}
    assert got == {(r["doc_id"], r["n_tokens"], round(float(x), 4)) for r, x in zip(rows, rate)}
