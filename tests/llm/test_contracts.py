"""The registered queries against plain versions, on the awkward rows and on the smallest tables."""

import math

import brute
import pytest
from fixed import SF

from varzea.llm import queries as llm

Q = llm.queries()


def key(x):
    return tuple((v is not None, v if v is not None else 0) for v in x)


@pytest.fixture(scope="module", params=["odd", "sf"])
def where(request, odd_dir):
    return odd_dir if request.param == "odd" else SF


@pytest.fixture(scope="module")
def docs(spark, where):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()]


def test_language_model_base(spark, where, docs):
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in Q["op1_lm_elias_fano"](spark, where).collect()), key=key)
    want = sorted(((i, *x) for (i, _), x in zip(docs, brute.lm_base(docs))), key=key)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert all(math.isclose(a[4], b[4], rel_tol=1e-9) for a, b in zip(got, want))


def test_language_model_beats_base_where_held_out(spark):
    rows = [r for r in Q["op1_lm_elias_fano"](spark, SF).collect() if r["held_out"]]
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_quality_counts(spark, where, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = Q["op3_quality_divergence"](spark, where).collect()
    got = sorted(((r["doc_id"], *(r[n] for n in names)) for r in rows), key=key)
    assert got == sorted(((i, *brute.quality_base(t)) for i, t in docs), key=key)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_repeated_passages(spark, where, docs):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in Q["op6_suffix_dedup"](spark, where).collect()), key=key)
    assert got == sorted(brute.repeats(docs), key=key)


def test_fingerprints_and_components(spark, where, docs):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in Q["op9_simhash_pivots"](spark, where).collect()), key=key)
    prints = [(i, brute.fingerprint(t)) for i, t in docs]
    assert got == sorted(((i, f"{f:016x}", c) for (i, f), c in zip(prints, brute.components(prints))), key=key)


def test_contained_items(spark, where, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{where}/benchmark.parquet").collect()]
    got = sorted(((r["doc_id"], r["item_id"], r["shared"], r["n_shingles"]) for r in Q["op10_decontamination"](spark, where).collect()), key=key)
    assert got and got == sorted(brute.contained(docs, items), key=key)


@pytest.mark.parametrize("name, n, rest", [("op1_lm_elias_fano", 7, 2), ("op5_language_id", 5, 0), ("op7_quality_attention", 4, 2), ("op8_toxicity_fm", 3, 1)])
def test_folds_and_ranges(spark, where, docs, name, n, rest):
    rows = Q[name](spark, where).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == sorted((i is not None, i or 0) for i, _ in docs)
    # a null id is held out of the language model, and of no other operator
    assert all(r["held_out"] is (name.startswith("op1_") if r["doc_id"] is None else brute.mod(r["doc_id"], n) == rest) for r in rows)
    if name != "op1_lm_elias_fano":
        assert all(0 <= r["score"] <= 1 for r in rows)
    if name in ("op7_quality_attention", "op8_toxicity_fm"):
        assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty_dir, name):
    assert Q[name](spark, empty_dir).collect() == []


def test_rates_are_nonnegative_and_whole(spark, where, docs):
    rows = Q["op4_mixing"](spark, where).collect()
    assert len(rows) == len(docs) and all(r["rate"] >= 0 for r in rows)


def test_page_texts_of_awkward_pages(spark, odd_dir):
    rows = {(r["page_id"], r["url"]): r for r in Q["op2_html_bilstm"](spark, odd_dir).collect()}
    assert rows[2, None]["text"] == "" and rows[3, "u"]["n_chars"] == 0 and rows[6, "u"]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert "Menu" not in rows[1, "u"]["text"]


def test_items_beyond_their_bound_are_found(spark, monkeypatch):
    """Whether the table of bits has room or is full, and whatever the sizes."""
    import random

    from varzea.llm import decontamination as d

    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 12, 14, 20, 40, 90] * 6)]
    docs = [(i, " ".join(word() for _ in range(60)) + " " + items[i % len(items)][1] + " " + " ".join(word() for _ in range(60))) for i in range(150)]
    want = sorted(brute.contained(docs, items))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (d.MOST_BITS, 1 << 10):
        monkeypatch.setattr(d, "MOST_BITS", most)
        keyed = d.with_row(frames[0])
        found = d.containment(keyed, frames[1]).join(keyed.select("row", "doc_id"), "row")
        assert sorted((r["doc_id"], r["item_id"], r["shared"], r["size"]) for r in found.collect()) == want


@pytest.mark.parametrize("blocks", [6, 7, 9])
def test_links_of_any_ids_and_cuts(spark, monkeypatch, blocks):
    """Ids near the ends of their range, and longer keys: the same components as by comparing all pairs."""
    import random

    from varzea.llm import simhash

    rng = random.Random(blocks)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = [b ^ sum(1 << x for x in rng.sample(range(64), k)) for b in base for k in (0, 2, 4, 5, 7)]
    prints += prints[:20]
    ids = [rng.choice([0, 1 << 62, (1 << 63) - 1, -(1 << 63)]) + rng.choice([1, -1]) * 0 if rng.random() < 0.1 else rng.randrange(-(1 << 62), 1 << 62) for _ in prints]
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in zip(ids, prints)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    monkeypatch.setattr(simhash, "cuts", lambda n: [(64 * i // blocks, 64 * (i + 1) // blocks - 64 * i // blocks) for i in range(blocks)])
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = sorted((i, f, c) for (i, f), c in zip(rows, brute.components(list(zip(ids, prints)))))
    assert sorted((r["doc_id"], r["fp"], r["component_id"]) for r in got) == want
