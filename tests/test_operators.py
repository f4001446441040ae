import json

from pyspark.sql import functions as F

from varzea.operators import layers, rules
from varzea.sources import files, pages
from varzea.streaming import stateful


def test_raw_append_is_idempotent(spark):
    rows = spark.createDataFrame([("a", "s", "r", "h1", 1), ("b", "s", "r", "h2", 2), ("c", "s", "r", "h1", 3)], "id string, source string, source_ref string, content_hash string, ingested_at int")
    once = layers.append_raw(rows)
    assert sorted((r["id"], r["version"], r["superseded_by_id"]) for r in once.collect()) == [("a", 1, "b"), ("b", 2, None)]
    again = layers.append_raw(rows, once.select(*rows.columns))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.select(*again.columns).collect()))


def test_promotion_of_equal_content_is_a_no_op(spark):
    held = spark.createDataFrame([("r", "x", 1, None), ("q", "y", 2, None)], "source_ref string, content string, version int, superseded_by_id string")
    new = spark.createDataFrame([("r", "x"), ("q", "z"), ("n", "w")], "source_ref string, content string")
    assert sorted((r["source_ref"], r["version"]) for r in layers.promote(new, held).collect()) == [("n", 1), ("q", 3)]


def test_merge_keeps_concurrent_keys(spark):
    d = spark.createDataFrame([({"a": "1", "b": "9"}, {"a": "1"}, {"a": "2"})], "c map<string,string>, f map<string,string>, t map<string,string>")
    assert d.select(layers.merge_changed(F.col("c"), F.col("f"), F.col("t"))).first()[0] == {"a": "2", "b": "9"}


def test_retention_keeps_failures(spark):
    d = spark.createDataFrame([("fail", 1), ("ok", 1), ("ok", 9)], "status string, created_at int")
    assert sorted(map(tuple, layers.retain(d, F.lit(5)).collect())) == [("fail", 1), ("ok", 9)]


def test_quarantine_names_every_broken_rule(spark):
    good, bad = layers.quarantine(spark.createDataFrame([(1,), (-1,), (None,)], "x int"), {"positive": F.col("x") > 0, "small": F.col("x") < 10})
    assert good.count() == 1 and sorted(tuple(r["broken_rules"]) for r in bad.collect()) == [("positive",), ("positive", "small")]


def test_edges_compare_null_states(spark):
    d = spark.createDataFrame([(None, "discovered"), ("discovered", "approved")], "before string, after string")
    assert sorted((r["after"], r["allowed"]) for r in rules.edge_allowed(spark, d).collect()) == [("approved", False), ("discovered", True)]


def test_refunds_do_not_go_below_zero(spark):
    d = spark.sql("SELECT 'd' AS k, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, at, 30) AS at, delta FROM VALUES (1, 2), (2, -5), (2, 1), (3, 4), (9, -1) v(at, delta)").withColumn("n", F.col("delta"))
    assert stateful.floored_counters(d, "k", "at", ["n"], "delta").first()["total"] == 4


def test_stream_and_batch_state_machines_agree(spark, tmp_path):
    moves = [(k, i, m) for k in (1, 2) for i, m in enumerate(["discovered", "signals", "approved", "contacts"][: 5 - k])]
    spark.createDataFrame(moves, "k long, at long, m string").write.parquet(f"{tmp_path}/in")
    batch = stateful.machine_batch(spark.read.parquet(f"{tmp_path}/in"), "k", ["at"], "m")
    stream = stateful.machine_stream(spark.readStream.schema("k long, at long, m string").parquet(f"{tmp_path}/in"), "k", ["at"], "m")
    q = stream.writeStream.format("memory").queryName("machines").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("machines").collect())) == sorted(map(tuple, batch.collect()))


def test_csv_with_blanks_and_bad_lines(spark, tmp_path):
    (tmp_path / "m.csv").write_text("ibge_code,nome,uf,lat,lng\n 2927408 , Salvador ,BA, -12.97 ,-38.5\nx,y,z,notanumber,1\n")
    rows = files.municipalities(spark, f"file://{tmp_path}/m.csv").collect()
    assert (rows[0]["ibge_code"], rows[0]["nome"], rows[0]["lat"]) == ("2927408", "Salvador", -12.97)
    assert rows[1]["_corrupt_record"] is not None


def test_geo_ids(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"BA": 303251,\n "SP": 303598}')
    assert sorted(map(tuple, files.geo_ids(spark, f"file://{tmp_path}/g.json").collect())) == [("BA", 303251), ("SP", 303598)]


def test_listing_ends_at_the_first_empty_page(spark, tmp_path):
    lines = ['{"listing":"l","offset":0,"cards":[{"name":"a","locationId":1},{"name":"b"}]}', '{"listing":"l","offset":30,"cards":[]}', '{"listing":"l","offset":60,"cards":[{"name":"c","locationId":3}]}']
    (tmp_path / "p.json").write_text("\n".join(lines))
    assert [r["name"] for r in files.listing_pages(spark, f"file://{tmp_path}/p.json").collect()] == ["a"]


def test_nodes_of_embedded_json(spark):
    rows = spark.createDataFrame([(1, json.dumps({"a": '{"id": 1, "b": [{"id": 2}]}', "id": 0}))], "k int, body string")
    found = pages.find_nodes(rows, "k", "body", pages.has_key("id")).selectExpr("try_variant_get(node, '$.id', 'int') AS id")
    assert sorted(r["id"] for r in found.collect()) == [0, 1, 2]


def test_library_does_not_import_the_corpus_package():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "varzea"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "varzea.llm" in p.read_text()]
