"""Held-out results of the trained models, and exactness of what they are made of."""

import brute
import numpy as np
import pytest
from fixed import SF

from varzea.llm import html_extraction, lm_scoring, mixing, toxicity
from varzea.llm import queries as llm
from varzea.llm.elias_fano import EliasFano, Trie

Q = llm.queries()
SF01 = "/root/testdata/sf0.01"


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (9000, 20_000), (9000, 10**15)):
        v = np.unique(rng.integers(0, top, n))
        e = EliasFano.encode(v)
        if n:
            assert (e.at(np.arange(len(v))) == v.astype(np.uint64)).all()
        ask = np.unique(np.concatenate([v, rng.integers(0, top, 50)])).astype(np.uint64)
        where = {x: i for i, x in enumerate(v.tolist())}
        want = [where.get(x, -1) for x in ask.tolist()]
        assert e.find(ask).tolist() == want


@pytest.mark.parametrize("order", [2, 3])
def test_trie_gives_smoothed_probabilities(tmp_path, order):
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 12, (600, order)), axis=0)
    count = np.where(rng.random(len(grams)) < 0.6, rng.integers(1, 9, len(grams)), 0)
    names = np.unique(rng.integers(100, 10**12, 40))[:12]
    history = [tuple(g[:-1]) for g in grams.tolist()]
    totals = {h: int(sum(c for x, c in zip(history, count) if x == h)) + 3 * (h[0] % 2) for h in set(history)}  # successors elsewhere
    total = np.array([totals[h] for h in history])
    Trie.build(names, tuple(grams.T), count, total, 7.0).save(str(tmp_path / "t"))
    trie = Trie.load(str(tmp_path / "t"))
    number = trie.numbers(names)
    a, b = trie.weights(tuple(number[g] for g in grams.T))
    assert a == pytest.approx(count / (total + 7), rel=0.05, abs=1e-9) and b == pytest.approx(7 / (total + 7), rel=0.05)


@pytest.mark.parametrize("entries", [lm_scoring.SHARD_ENTRIES, 300, 60])
def test_scores_are_those_of_one_trigram_model(spark, entries):
    """Whatever the number of shards, frequent words and histories spread over several of them or not."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, i % 4 == 1, " ".join(words[min(39, int(x))] for x in rng.exponential(4, int(rng.integers(0, 60))))) for i in range(120)]
    got = lm_scoring.score(spark.createDataFrame(docs, "doc_id long, held_out boolean, text string"), entries, 2000).collect()
    want = brute.lm_score([(i, h, t) for i, h, t in docs], lm_scoring.MU)
    assert len(got) == len(docs)
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=0.008 * r["n_tokens"])


def test_frequent_histories_are_spread(spark):
    """Of two parts that share a history each gives the weights of the whole."""
    t = lm_scoring.Tokens.__new__(lm_scoring.Tokens)
    g = lm_scoring.Grams.__new__(lm_scoring.Grams)
    g.names, g.totals = (np.full(1000, 7), np.arange(1000)), np.full(1000, 900)
    assert len(g._cut(64, 1000).shard) > 32 and t is not None
    g.totals = np.full(1000, 1)
    assert len(g._cut(64, 1000).shard) == 1


def test_frequent_continuations_score_higher(spark):
    """Of one history: a word seen after it often beats a rare one, and a seen word an unknown one."""
    texts = [(i, False, "a b a c a b d") for i in range(20)]
    ask = [(100 + i, True, f"a b {w}") for i, w in enumerate(["a", "b", "c", "d", "zzz"])] + [(200, True, "a b")]
    got = {r["doc_id"]: r for r in lm_scoring.score(spark.createDataFrame(texts + ask, "doc_id long, held_out boolean, text string")).collect()}
    assert got[102]["score"] < got[100]["score"] and got[104]["score"] < got[103]["score"]


def labelled(spark, name, column):
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    return [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in Q[name](spark, SF01).collect() if r["held_out"] and r["doc_id"] in labels]


@pytest.mark.parametrize("name, column, least", [("op7_quality_attention", "quality", 0.9), ("op8_toxicity_fm", "toxic", 0.85)])
def test_held_out_ranking(spark, name, column, least):
    rows = labelled(spark, name, column)
    good, bad = [s for s, _, y in rows if y == 1], [s for s, _, y in rows if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= least, auc


def test_held_out_languages(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in Q["op5_language_id"](spark, SF01).collect() if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) >= 0.95


def test_semantic_pages(spark):
    """Pages whose tags say what is main text are extracted as the tags say."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows, right, n = Q["op2_html_bilstm"](spark, SF).collect(), 0, 0
    for r in rows:
        found = html_extraction.blocks(pages[r["page_id"]] or "")
        said = [html_extraction.teacher(p) for p, _, _ in found]
        if found and None not in said:
            n += 1
            right += r["text"] == "\n\n".join(t for (_, t, _), s in zip(found, said) if s == 1.0)
    assert n and right / n >= 0.9, (right, n)


def test_blocks_decode_and_join():
    page = "<p>One&nbsp;&amp; two<br>three</p><script>var a = '<p>no</p>';</script><ul><li>x<li>y</ul><!-- <p>no</p> -->tail"
    assert [t for _, t, _ in html_extraction.blocks(page)] == ["One & two three", "x", "y", "tail"]


def test_mixing_meets_its_targets(spark):
    rows = Q["op4_mixing"](spark, SF01).collect()
    total = sum(r["n_tokens"] for r in rows)
    mass = {k: sum(r["rate"] * r["n_tokens"] * r[f"p_{k}"] for r in rows) / total for k in mixing.DOMAINS}
    alone = {k: sum(r["n_tokens"] * r[f"p_{k}"] for r in rows) / total for k in mixing.DOMAINS}
    live = {k for k in mixing.DOMAINS if alone[k] >= mixing.MIN_MASS}
    want = {k: (mixing.TARGETS[k] if k in live else 0) / sum(mixing.TARGETS[x] for x in live) for k in mixing.DOMAINS}
    assert max(abs(mass[k] - want[k]) for k in mixing.DOMAINS) < 0.01


def test_a_pair_of_neutral_terms_is_learned():
    """Each of two terms is as frequent among harmless texts as among toxic ones; only both together are toxic. No sum of weights tells them apart."""
    rng = np.random.default_rng(8)
    rows, y = [], []
    for _ in range(4000):
        words = {int(x) for x in rng.integers(10, 400, 20)}
        kind = rng.integers(0, 12)
        words |= {0: {1, 2}, 1: {1}, 2: {2}, 3: {1}, 4: {2}}.get(int(kind), set())
        rows.append(np.array(sorted(words), dtype=np.int64))
        y.append(float(kind == 0))
    y = np.array(y)
    cut = 3000
    pack = lambda part: (np.concatenate(part), np.array([len(r) for r in part], dtype=np.int64))
    fm = toxicity.train(*pack(rows[:cut]), y[:cut])
    assert {1, 2} <= set(fm.ids.tolist())
    s = fm.score(*pack(rows[cut:]))
    assert s[y[cut:] == 1].min() > 0.7 and s[y[cut:] == 0].max() < 0.3
