"""Candidate search of fuzzy joins against all pairs, and neighbours by cells against exact ones."""

import random

import numpy as np
import plain_ratios
import pytest
from pyspark.sql import functions as F

from varzea.functions import fuzzy
from varzea.operators import matching, neighbours, resolve

SF = "/root/testdata/sf0.01"


def names(rng, n):
    words = "são joão praia grande da barra ilha bela vista morro de paulo cachoeira alta a é x² ponta negra rio vermelho rara".split()
    out = []
    for _ in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 5))]
        t = rng.choice([" ", "-", "  ", "_"]).join(w)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(t) + 1)
            t = t[:at] + rng.choice("abeo é-") * rng.randrange(2) + t[at + rng.randrange(2) :]
        out.append(t.title() if rng.random() < 0.3 else t)
    return [None, "", "a", "AB", "rara rara rara", "ΣΑΣ ΣΑΣ", *out]


@pytest.mark.parametrize("kind, least", [("sort", 88.0), ("sort", 60.0), ("set", 88.0), ("set", 72.0), ("set", 50.0)])
def test_no_pair_is_lost(spark, kind, least):
    rng = random.Random(int(least))
    left, right = ([(i, rng.choice("uv"), x) for i, x in enumerate(names(rng, 150))] for _ in range(2))
    score = {"sort": plain_ratios.sort_ratio, "set": plain_ratios.set_ratio}[kind]
    want = {(a, b) for a, p, x in left for b, q, y in right if p == q and x is not None and y is not None and score(x, y) >= least}
    frames = (spark.createDataFrame(x, "id long, block string, name string") for x in (left, right))
    assert {(r["l"], r["r"]) for r in matching.similar(*frames, least, kind).collect()} == want and want


def test_few_pairs_are_compared(spark):
    """Of names of a block that are unlike each other, under 5 % of the pairs reach Python."""
    p = spark.read.parquet(f"{SF}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("block"), F.col("p_name").alias("name"))
    made = [matching.prepared(x, 88.0) for x in (p, p)]
    every = p.groupBy("block").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    assert matching.candidates(*made, 88.0, False).count() < 0.05 * every


def test_partial_ratio_equals_all_stretches():
    rng = random.Random(2)

    for _ in range(1500):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 12))) for _ in range(2))
        assert fuzzy.partial_ratio(a, b) == pytest.approx(plain_ratios.partial_ratio(a, b)), (a, b)
    assert fuzzy.partial_set_ratio("morro", "orro xx") == pytest.approx(100 * 8 / 9)
    assert fuzzy.partial_set_ratio("", "x") == 0.0 and fuzzy.partial_set_ratio("a b", "B c") == 100.0


def test_set_ratio_equals_a_plain_one():
    rng = random.Random(9)
    for _ in range(1500):
        a, b = (" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(0, 4))) for _ in range(2))
        assert fuzzy.set_ratio(a, b) == pytest.approx(plain_ratios.set_ratio(a, b)), (a, b)


def test_no_partial_match_is_lost(spark):
    rng = random.Random(31)
    left, right = ([(i, rng.choice("uv"), x) for i, x in enumerate(names(rng, n))] for n in (60, 150))
    want = {(a, b) for a, p, x in left for b, q, y in right if p == q and x is not None and y is not None and plain_ratios.partial_set_ratio(x, y) >= 88}
    frames = (spark.createDataFrame(x, "id long, block string, name string") for x in (left, right))
    assert {(r["l"], r["r"]) for r in matching.partly_similar(*frames, 88.0).collect()} == want and want


@pytest.mark.parametrize("which, least", [("table", 0.2), ("table", 0.3), ("groups", 0.7)])
def test_recall_of_cells(spark, which, least):
    """Vectors without any structure (those of the table), where about half of the cells are searched, and vectors in groups."""
    if which == "table":
        e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("label", "vec_id", "embedding")
    else:
        rng = np.random.default_rng(1)
        centre = rng.normal(size=(40, 32))
        x = centre[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 32))
        e = spark.createDataFrame([(int(i % 2), i, v.tolist()) for i, v in enumerate(x)], "label int, vec_id long, embedding array<double>")
    exact = {(r["a"], r["b"]) for r in resolve.knn_in_block(e, ["label"], "vec_id", "embedding", 10, least).collect()}
    found = neighbours.nearest_by_cells(e, ["label"], "vec_id", "embedding", 10, least).collect()
    got = {(r["a"], r["b"]) for r in found}
    assert exact and len(got & exact) >= 0.9 * len(exact), len(got & exact) / len(exact)
    assert all(r["rank"] <= 10 and r["similarity"] > least for r in found)


def test_few_cells_are_searched_where_vectors_lie_in_groups():
    rng = np.random.default_rng(3)
    x = neighbours.units((rng.normal(size=(40, 32))[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 32))).tolist(), 32)
    centres = neighbours.fit_cells(x, 100)
    assert neighbours.probes_for(x, centres, 10, 0.95) <= 12


def test_all_cells_and_small_tiles_are_exact(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id < 300")
    odd = spark.createDataFrame([(1000, None, 0), (1001, [0.0] * 2, 0)], "vec_id long, embedding array<double>, label int")
    e = e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("int").alias("label")).unionByName(odd)
    rows = lambda d: sorted((r["a"], r["b"], r["rank"]) for r in d.collect())
    want = rows(resolve.knn_in_block(e, ["label"], "vec_id", "embedding", 5, 0.1))
    assert want and rows(neighbours.nearest_by_cells(e, ["label"], "vec_id", "embedding", 5, 0.1, cells=9, probes=9, tile=11)) == want
