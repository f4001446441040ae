"""Canonical JSON and its hash against the standard library's."""

import hashlib
import json

from pyspark.sql import functions as F

from varzea.functions.canonical import canonical_json, content_hash
from varzea.operators import layers

VALUES = [{"b": 1, "a": {"d": [1, 2.5, None, True], "c": "é\n  😀 \"\\ \x7f"}}, [], {}, None, True, 0, -1.0, 1e300, 12345678901234567890, "", "ü", {"": {"": [[]]}}, [{"z": 1, "a": 2}, {"y": None}], {"10": 1, "9": 2, "é": 3, "Z": 4, "a": 5}]


def test_of_texts(spark):
    texts = [json.dumps(v, ensure_ascii=i % 2 == 0, separators=(",", ":")) for i, v in enumerate(VALUES)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "{", "", "[1,]"])], "id int, t string")
    got = {r["id"]: (r["c"], r["h"]) for r in rows.select("id", canonical_json(F.col("t")).alias("c"), content_hash(F.col("t")).alias("h")).collect()}
    for i, v in enumerate(VALUES):
        want = json.dumps(v, sort_keys=True)
        assert got[i] == (want, hashlib.sha256(want.encode()).hexdigest())
    assert [got[len(VALUES) + i] for i in range(4)] == [(None, None)] * 4


def test_of_nested_columns(spark):
    row = spark.sql("SELECT named_struct('z', 1, 'a', array(named_struct('y', CAST(NULL AS INT), 'b', 'é'), NULL), 'm', map('q', 2.5D, 'c', NULL)) AS x").select(canonical_json(F.col("x"), False).alias("c")).first()
    assert row["c"] == json.dumps({"z": 1, "a": [{"y": None, "b": "é"}, None], "m": {"q": 2.5, "c": None}}, sort_keys=True)


def test_equal_payloads_are_one_version(spark):
    rows = spark.createDataFrame([(1, "s", "r", 1, '{"a":1,"b":[2]}'), (2, "s", "r", 2, '{ "b": [2], "a": 1 }'), (3, "s", "r", 3, '{"a":1.0,"b":[2]}')], "id long, source string, source_ref string, ingested_at long, payload string")
    assert sorted((r["id"], r["version"]) for r in layers.append_raw(layers.with_content_hash(rows)).collect()) == [(1, 1), (3, 2)]
