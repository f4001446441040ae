"""The stages of the pipeline, each on the awkward rows, on an empty table, and against a plain version."""

import brute
import corpus_pipeline
import pytest
from fixed import SF

from varzea.llm.quality_rules import STAGE_MIN_WORDS, judge


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("which", ["odd", "empty"])
def test_awkward_rows(spark, odd_dir, empty_dir, stage, which):
    d = odd_dir if which == "odd" else empty_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    out = stage(spark, docs, d)
    rows = out.collect()
    assert set(docs.columns) <= set(out.columns)
    assert len(set(out.columns)) == len(out.columns)
    assert bool(rows) == (which == "odd")


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    judged = {r["doc_id"]: r for r in judge(docs, min_words=STAGE_MIN_WORDS).collect()}
    assert all(judged[i]["kept"] for i, t in rows if 0 < len((t or "").split()) < 50 and judged[i]["n_repeat_words"] == 0 and judged[i]["word_chars"] < 200)
    rows = [r for r in rows if judged[r[0]]["kept"]]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs.filter(docs.doc_id.isin([r[0] for r in rows])), SF).collect()}
    rows = [r for r in rows if r[0] in kept]
    left = {x[0]: x[1] - x[2] for x in brute.repeats(rows)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got and set(got) <= set(left)
    assert not brute.contained([(i, r["text"]) for i, r in got.items()], items)
    assert all(len(got[i]["text"].encode()) in range(left[i] - 6, left[i] + 1) for i in got)


def test_near_copies_leave_one(spark):
    base = " ".join(f"word{i}" for i in range(300))
    docs = spark.createDataFrame([(i, base if i % 2 else base + " tail") for i in range(10)] + [(50, "something else entirely " * 3)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 50]


@pytest.mark.parametrize("apply", ["judge", "mix", "remove_repeats", "predict", "toxicity", "quality", "extract"])
def test_operators_beside_clashing_columns(spark, odd_dir, apply):
    """Their own interface: every row comes back once, columns that have the name of a result are replaced."""
    from varzea.llm import html_extraction, language_id, mixing, quality_classifier, suffix_dedup, toxicity

    docs, labels, pages = (spark.read.parquet(f"{odd_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    out = {
        "judge": lambda: judge(docs),
        "mix": lambda: mixing.mix(docs, labels),
        "remove_repeats": lambda: suffix_dedup.remove_repeats(docs),
        "predict": lambda: language_id.predict(docs, language_id.fit(docs)),
        "toxicity": lambda: toxicity.score(docs, toxicity.fit(docs, labels)),
        "quality": lambda: quality_classifier.score(docs, quality_classifier.fit(docs, labels)),
        "extract": lambda: html_extraction.extract(pages, html_extraction.fit(pages, composed=20)),
    }[apply]()
    assert len(set(out.columns)) == len(out.columns)
    assert len(out.collect()) == (pages if apply == "extract" else docs).count()
