"""Scores worked out again plainly, a number at a time, from a model's parameters: recurrent labels, language probabilities,
attention over passages, pairs of terms."""

import math

import numpy as np
import pytest

from varzea.llm import html_extraction, language_id, quality_classifier, toxicity


def sig(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(z)))))


def test_recurrent_labels():
    rng, h = np.random.default_rng(1), html_extraction.HIDDEN
    model = html_extraction.Labeller()
    model.p = {k: rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in model.p.items()}
    pages = [html_extraction.vectors(html_extraction.blocks("".join(f"<{t} class='c{i % 3}'>word {i} some, text.</{t}>" for i, t in enumerate(["p", "li", "h1", "td", "p"] * n)))) for n in (1, 3, 2)]
    for page, got in zip(pages, model.label(pages)):
        states = {}
        for side, order in (("f", range(len(page))), ("b", reversed(range(len(page))))):
            hid, cell = [0.0] * h, [0.0] * h
            for t in order:
                z = [float(model.p[f"c{side}"][j]) + sum(float(page[t][k]) * float(model.p[f"W{side}"][k, j]) for k in np.flatnonzero(page[t])) + sum(hid[k] * float(model.p[f"R{side}"][k, j]) for k in range(h)) for j in range(4 * h)]
                cell = [sig(z[h + j]) * cell[j] + sig(z[j]) * math.tanh(z[3 * h + j]) for j in range(h)]
                hid = [sig(z[2 * h + j]) * math.tanh(cell[j]) for j in range(h)]
                states[side, t] = hid
        for t in range(len(page)):
            both = [*states["f", t], *states["b", t]]
            logit = float(model.p["o"][0]) + sum(x * float(w) for x, w in zip(both, model.p["O"][:, 0])) + sum(float(page[t][k]) * float(model.p["S"][k, 0]) for k in np.flatnonzero(page[t]))
            assert got[t] == pytest.approx(sig(logit), abs=2e-4)


def test_language_probabilities():
    rng = np.random.default_rng(2)
    model = language_id.LanguageModel(["a", "b", "c"], rng.normal(0, 3, (language_id.BUCKETS, 3)).astype(np.float32), rng.normal(0, 1, 3).astype(np.float32), 0.7, 0.5)
    for text in ("The  cat\tsat", "été", "", "x"):
        raw = " ".join([""] + ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)] + [""]).encode()
        data = []
        for b in raw:  # runs of white space are one blank
            blank = b in b" \t\n\r\x0b\x0c"
            if not (blank and data and data[-1] == 32):
                data.append(32 if blank else b)
        if not text:
            data = [32, 32]
        count = {}
        for n in language_id.ORDERS:
            for i in range(len(data) - n + 1):
                v = data[i]
                for b in data[i + 1 : i + n]:
                    v = (v * 16777619 & 0xFFFFFFFF) ^ b
                bucket = ((v * 2654435769 + n * 40503) & 0xFFFFFFFF) >> 19
                count[bucket] = count.get(bucket, 0) + 1
        total = max(1, sum(count.values()))
        z = [(sum(n / total * float(model.logits[k, j]) for k, n in count.items()) + float(model.bias[j])) / model.temperature for j in range(3)]
        e = [math.exp(x - max(z)) for x in z]
        assert model.probabilities(language_id.histograms([text.encode()]))[0] == pytest.approx([x / sum(e) for x in e], abs=1e-4), text


def test_attention_over_passages():
    rng, model = np.random.default_rng(3), quality_classifier.AttentionModel()
    model.p = {k: rng.normal(0, 0.4, v.shape).astype(np.float32) for k, v in model.p.items()}
    model.mean, model.scale = rng.normal(0, 0.1, model.mean.shape).astype(np.float32), rng.uniform(0.5, 2, model.scale.shape).astype(np.float32)
    texts = [" ".join(f"w{(i * k) % 17}" for i in range(n)).encode() for k, n in ((1, 900), (3, 40), (2, 0), (5, 300))]
    for part, x, count in quality_classifier.bags(texts):
        got, at = model.score(x, count), 0
        for i, n in enumerate(count):
            rows = [[(float(v) - float(m)) * float(s) for v, m, s in zip(r, model.mean, model.scale)] for r in x[at : at + n]]
            at += n
            dense = lambda v, w, b=None: [sum(a * float(c) for a, c in zip(v, w[:, j])) + (float(b[j]) if b is not None else 0.0) for j in range(w.shape[1])]
            e = [[math.tanh(z) for z in dense(r, model.p["We"], model.p["be"])] for r in rows]
            s = [max(-20.0, min(20.0, sum(math.tanh(t) * sig(g) * float(a) for t, g, a in zip(dense(v, model.p["V"]), dense(v, model.p["U"]), model.p["a"])))) for v in e]
            u = [math.exp(v - max(s)) for v in s]
            z = [sum(w / sum(u) * v[j] for w, v in zip(u, e)) for j in range(len(e[0]))]
            assert got[i] == pytest.approx(sig(sum(a * float(b) for a, b in zip(z, model.p["w"])) + float(model.p["b"][0])), abs=1e-4)


def test_pairs_of_terms():
    rng = np.random.default_rng(4)
    texts = [b"one two three", b"one ONE one", b"", b"unknown words", b"two three four five six seven"]
    (_, term, count), = toxicity.term_sets(texts)
    ids = np.unique(term)[::2]
    model = toxicity.FactorizationMachine(ids)
    model.w, model.V, model.bias = rng.normal(0, 1, len(ids)), rng.normal(0, 1, model.V.shape), 0.3
    at = 0
    for got, n in zip(model.score(term, count), count):
        own = [int(np.searchsorted(ids, t)) for t in term[at : at + n] if t in ids]
        at += n
        z = model.bias + sum(model.w[i] for i in own) + sum(float(np.dot(model.V[a], model.V[b])) for k, a in enumerate(own) for b in own[k + 1 :])
        assert got == pytest.approx(sig(z), abs=1e-9)


def test_pairs_without_a_bound_equal_all_pairs():
    """Which terms belong to a telling pair: as by looking at every two terms."""
    rng = np.random.default_rng(5)
    n, y = 900, np.zeros(900)
    has = rng.random((n, 40)) < 0.3
    y[has[:, 3] & has[:, 7]] = 1
    y[rng.random(n) < 0.05] = 1
    term, count = np.nonzero(has)[1], has.sum(1)
    ids, at, df = np.unique(term, return_inverse=True, return_counts=True)
    hits = np.bincount(at, weights=np.repeat(y, count), minlength=len(ids))
    want = np.zeros(len(ids), dtype=bool)
    for i in range(len(ids)):
        for j in range(i):
            both = has[:, ids[i]] & has[:, ids[j]]
            one, share = float((both & (y == 1)).sum()), max(hits[i] / df[i], hits[j] / df[j])
            if min(hits[i], hits[j], one) >= 5 and one > both.sum() * share and toxicity.chi_square(one, both.sum(), min(share, 0.999)) >= toxicity.MIN_PAIR_CHI2:
                want[[i, j]] = True
    got = toxicity.paired(term, count, y, ids, at, df, hits, 5)
    assert (got == want).all() and {3, 7} <= set(ids[got].tolist())
