"""The page source over a stop and a restart, the stage machine's step, nested search, and lookups that must not miss."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from varzea.sources import files, page_stream, pages
from varzea.streaming import machine


def land(folder, listing, page, cards):
    path = folder / listing
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{page}.json").write_text(json.dumps(cards))


def test_pages_after_a_stop_half_way(spark, tmp_path):
    """A batch that fails is read again, further pages go on where the last ones ended, nothing lies twice in the result."""
    source, seen = tmp_path / "in", []

    def run(fail):
        def sink(batch, number):
            rows = [(number, r["listing"], r["page"], r["position"], json.loads(r["card"])["id"]) for r in batch.collect()]
            if fail:
                raise ValueError("stopped")
            seen.extend(rows)

        q = page_stream.page_stream(spark, str(source)).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()

    for page in range(3):
        land(source, "a", page, [{"id": f"a{page}{i}"} for i in range(2)])
    land(source, "b", 0, [{"id": "b00", "é": "ü"}])
    land(source, "b", 1, [])
    land(source, "b", 2, [{"id": "never"}])  # behind an empty page
    land(source, "c", 1, [{"id": "later"}])  # page 0 has not landed
    run(False)
    first = list(seen)
    assert sorted(x[1:3] for x in first) == [("a", 0), ("a", 0), ("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", 0)]
    land(source, "a", 3, [{"id": "a30"}])
    land(source, "c", 0, [{"id": "c00"}])
    with pytest.raises(PySparkException):
        run(True)
    land(source, "a", 4, [{"id": "a40"}])
    run(False)
    run(False)
    assert sorted(x[4] for x in seen) == sorted(["a00", "a01", "a10", "a11", "a20", "a21", "a30", "a40", "b00", "c00", "later"])


def test_a_move_counts_from_the_state_that_it_expects():
    assert machine.step(None, None, "discovered") == ("discovered", True)
    assert machine.step("discovered", "signals", "contacts") == ("discovered", False)  # expects another state
    assert machine.step("discovered", "discovered", "approved") == ("discovered", False)  # no edge
    assert machine.step("contacts", "contacts", "awaiting") == ("awaiting", True)


def nodes_of(value, depth=0):
    """Objects with an id, plainly; strings that hold JSON are opened."""
    if isinstance(value, str) and value.strip()[:1] in ("{", "["):
        try:
            value = json.loads(value)
        except ValueError:
            return []
    if depth > 40:
        return []
    children = value.values() if isinstance(value, dict) else value if isinstance(value, list) else []
    return ([value["id"]] if isinstance(value, dict) and "id" in value else []) + [x for c in children for x in nodes_of(c, depth + 1)]


def test_nested_search(spark):
    deep = {"id": "deep"}
    for i in range(60):
        deep = {"id": i, "in": deep} if i % 2 else {"list": [deep, i]}
    values = [deep, {"id": None, "a": [{"id": 1}, [[{"id": 2}]], "x", 3, None, True]}, {"s": json.dumps({"id": 5, "t": json.dumps([{"id": 6}])})}, [], {}, 7, {"bad": "{no", "id": "é"}]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(90, None), (91, "{"), (92, "")]
    found = pages.find_nodes(spark.createDataFrame(rows, "k int, body string"), "k", "body", pages.has_key("id"))
    got = sorted((r["k"], r["v"] or "null") for r in found.select("k", F.expr("to_json(try_variant_get(node, '$.id', 'variant'))").alias("v")).collect())
    want = sorted((i, json.dumps(x, ensure_ascii=False) if x is not None else "null") for i, v in enumerate(values) for x in nodes_of(v))
    assert got == want


def test_a_required_lookup_fails_on_a_miss(spark):
    rows, seed = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    assert {r["k"]: r["v"] for r in files.first_known(rows, "k", "v", seed).collect()} == {1: "x", 2: None}
    with pytest.raises(Exception, match="no v for 2"):
        files.first_known(rows, "k", "v", seed, required=True).collect()


def test_nodes_of_one_file_are_found_by_several_tasks_in_few_passes(spark, monkeypatch):
    """Levels are opened several at a time, over all tasks, whatever the file's splits; scalars are no rows."""
    held, plain = [], pages.checkpointed
    monkeypatch.setattr(pages, "checkpointed", lambda df: held.append(out := plain(df)) or out)
    deep = {"id": 4}
    for key in "hgfedcbaz":
        deep = {key: deep}
    body = json.dumps({"id": 1, "x": [1, "s", None, [{"id": 2, "y": json.dumps([{"id": 3}])}]], **deep})
    rows = spark.createDataFrame([(k, body) for k in range(50)], "k int, body string").coalesce(1)
    found = pages.find_nodes(rows, "k", "body", pages.has_key("id")).selectExpr("k", "try_variant_get(node, '$.id', 'int') AS id")
    assert sorted(map(tuple, found.collect())) == [(k, i) for k in range(50) for i in (1, 2, 3, 4)]
    assert len(held) == 2 and held[0].rdd.getNumPartitions() >= 4
    assert held[0].count() == 50 * 4  # three nodes and what is still to be opened
