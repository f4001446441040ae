"""Queries of Indel ratios against plain versions that compare every pair."""

import pytest
from plain_ratios import fold, partial_set_ratio, set_ratio, sort_ratio

from varzea.operators import resolve
from varzea.plans import registry

SF = "/root/testdata/sf0.001"
Q = registry.queries()


def test_fuzzy_place(spark):
    nations = spark.read.parquet(f"{SF}/nation.parquet").collect()
    by_code = {r["n_nationkey"]: r for r in nations}
    want = set()
    for c in spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_nationkey").collect():
        own = by_code[c["c_nationkey"]]
        typed = fold(own["n_name"].lower() + "s")
        scored = sorted((-sort_ratio(typed, fold(r["n_name"])), r["n_nationkey"]) for r in nations if r["n_regionkey"] == own["n_regionkey"])
        if -scored[0][0] >= 88:
            want.add((c["c_custkey"], scored[0][1], round(-scored[0][0], 6)))
    assert {(r["c_custkey"], r["place_code"], round(r["ratio"], 6)) for r in Q["fuzzy_place"](spark, SF).collect()} == want


def test_best_matches(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").collect()
    want = {}
    for a in p:
        if a["p_size"] % 5 == 0:
            near = [(-set_ratio(a["p_name"], b["p_name"]), b["p_partkey"]) for b in p if b["p_brand"] == a["p_brand"] and b["p_size"] % 5 and b["p_partkey"] % 2]
            best = min(near, default=(0, 0))
            if -best[0] >= 60:
                want[a["p_partkey"]] = best[1]
    assert {r["id"]: r["position"] for r in Q["best_matches"](spark, SF).collect()} == want


def test_token_ratios(spark):
    names = {r["p_partkey"]: (r["p_name"], r["p_type"]) for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    for r in Q["token_ratios"](spark, SF).collect():
        a, other = names[r["p_partkey"]]
        b = f"{a.split(' ')[1]} {other}"
        assert (r["sort"], r["set"], r["partial"]) == pytest.approx((sort_ratio(a, b), set_ratio(a, b), partial_set_ratio(a, b)))


def misspelt(name, key):
    return [" ".join(reversed(name.split(" "))), name[:3] + name[4:], name.upper() + name[-1], name][key % 4]


def test_fuzzy_district(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").collect()
    want = set()
    for a in p:
        scored = sorted((-sort_ratio(fold(misspelt(a["p_name"], a["p_partkey"])), fold(b["p_name"])), b["p_partkey"]) for b in p if b["p_brand"] == a["p_brand"])
        if -scored[0][0] >= 88:
            want.add((a["p_partkey"], scored[0][1], round(-scored[0][0], 6)))
    assert {(r["p_partkey"], r["place_code"], round(r["ratio"], 6)) for r in Q["fuzzy_district"](spark, SF).collect()} == want and want


def test_place_matches(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").collect()
    want = set()
    for a in p:
        k = a["p_partkey"]
        name = " ".join(a["p_name"].split(" ")[:3]) if k % 5 == 0 else misspelt(a["p_name"], k)
        best = min(((-set_ratio(name, b["p_name"]), b["p_partkey"]) for b in p if b["p_brand"] == a["p_brand"] and b["p_partkey"] % 3), default=(0, 0))
        if -best[0] >= 85:
            want.add((k, best[1], round(-best[0], 6)))
    assert {(r["id"], r["position"], round(r["ratio"], 6)) for r in Q["place_matches"](spark, SF).collect()} == want and want


def test_photo_matches(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").collect()
    want = []
    for a in p:
        uf, found = "BA" if a["p_partkey"] % 2 == 0 else "SP", []
        for b in p:
            hint = {0: "BA", 1: "SP"}.get(b["p_partkey"] % 3)
            if hint and hint != uf:
                continue
            hay = ordered_text(b["p_name"] + (" (Bahia)" if b["p_partkey"] % 3 == 0 else "") + " " + b["p_brand"] + (" - SP" if b["p_partkey"] % 3 == 1 else ""))
            n, m = set_ratio(ordered_text(a["p_name"]), hay), partial_set_ratio("bahia", hay)
            if n >= 88 or (n >= 72 and m >= 88):
                found.append((-(n if n >= 88 else round(0.7 * n + 0.3 * m)), -b["p_size"], b["p_partkey"]))
        want += [(a["p_partkey"], x[2], i) for i, x in enumerate(sorted(found)[:3], 1)]
    assert sorted((r["id"], r["photo"], r["rank"]) for r in Q["photo_matches"](spark, SF).collect()) == sorted(want)


def ordered_text(s):
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in fold(s)).split())


def test_neighbours_over_many_tiles(spark):
    """The same rows whether a block is one tile or many; ties by id."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    whole = sorted(map(tuple, resolve.knn_in_block(e, ["label"], "vec_id", "embedding", 3, 0.2).select("a", "b", "rank").collect()))
    tiles = sorted(map(tuple, resolve.knn_in_block(e, ["label"], "vec_id", "embedding", 3, 0.2, tile=7).select("a", "b", "rank").collect()))
    assert whole and whole == tiles
