"""Queries over the versioned layers and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions.scalars import reliability, route
from varzea.operators import insights, layers
from varzea.plans.bindings import EVENTS_SQL, NOW_EVENTS, RAW_SQL, ROUTES, SCORED_SQL, VERSIONS_SQL, event_rows, raw_rows, scored_orders, table
from varzea.plans.registry import query


@query(f"SELECT source, source_ref, id, content_hash, version, superseded_by_id FROM ({VERSIONS_SQL})")
def raw_version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.append_raw(raw_rows(spark, sf_dir)).select("source", "source_ref", "id", "content_hash", F.col("version").cast("long").alias("version"), "superseded_by_id")


_ESCAPED = "list_aggregate(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: CASE WHEN c IN (chr(34), chr(92)) THEN chr(92) || c WHEN c = chr(10) THEN chr(92) || 'n' WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) < 65536 THEN chr(92) || 'u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE chr(92) || 'u' || lower(to_hex(55296 + (unicode(c) - 65536) // 1024)) || chr(92) || 'u' || lower(to_hex(56320 + (unicode(c) - 65536) % 1024)) END), 'string_agg', '')"
_LINE = "left(text, 40) || chr(10) || chr(128512) || ' é " + '"' + "' || chr(92) || doc_id % 3"


@query(
    f"""WITH p AS (SELECT doc_id, source || ':' || lang || ':' || CAST(doc_id % 60 AS VARCHAR) AS source_ref, '{{"lang": "' || lang || '", "nested": {{"a": [1, 2.5, null, true, {{"b": 100000.0, "c": {{}}}}], "z": ' || (doc_id % 4) || '}}, "text": "' || {_ESCAPED.format(x=_LINE)} || '"}}' AS payload FROM documents),
h AS (SELECT *, sha256(payload) AS content_hash FROM p QUALIFY row_number() OVER (PARTITION BY source_ref, content_hash ORDER BY doc_id) = 1)
SELECT doc_id, content_hash, row_number() OVER (PARTITION BY source_ref ORDER BY doc_id) AS version FROM h"""
)
def raw_payload_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions by the hash of nested payloads, whose keys, blanks and escapes differ from row to row."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(k, "source", "lang", F.concat(F.substring("text", 1, 40), F.lit('\n\U0001f600 é "\\'), (k % 3).cast("string")).alias("line"))
    line = F.substring(F.to_json(F.struct(F.col("line").alias("x"))), 6, 10_000)  # "...."} with the quotes
    line = F.regexp_replace(line, r"\}$", "")
    nested = F.concat(F.lit('{"z":'), (k % 4).cast("string"), F.lit(',"a":[1,2.50,null,true,{"c":{ },"b":1e5}]}'))
    one = F.concat(F.lit('{"text":'), line, F.lit(',"lang":"'), "lang", F.lit('","nested":'), nested, F.lit("}"))
    other = F.concat(F.lit('{ "nested" : '), nested, F.lit(', "lang":"old","lang":"'), "lang", F.lit('",\n"text":'), line, F.lit("}"))
    rows = d.select(k.alias("id"), "source", F.concat_ws(":", "source", "lang", (k % 60).cast("string")).alias("source_ref"), k.alias("ingested_at"), F.when(k % 2 == 0, one).otherwise(other).alias("payload"))
    return layers.append_raw(layers.with_content_hash(rows)).select(F.col("id").alias("doc_id"), "content_hash", F.col("version").cast("long").alias("version"))


@query(f"SELECT source_ref, id, version FROM ({VERSIONS_SQL}) WHERE superseded_by_id IS NULL")
def raw_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.active(layers.append_raw(raw_rows(spark, sf_dir))).select("source_ref", "id", F.col("version").cast("long").alias("version"))


@query(f"SELECT count(*) AS n FROM ({VERSIONS_SQL})")
def raw_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending the same rows again adds nothing."""
    rows = raw_rows(spark, sf_dir)
    return layers.append_raw(rows, layers.append_raw(rows)).agg(F.count("*").alias("n"))


@query(f"SELECT source_ref AS canonical_key, id, CAST(version AS BIGINT) AS version FROM ({VERSIONS_SQL}) WHERE version = 1 AND uf <> 'es'")
def working_insert_or_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the working table lacks get the first version; the Spanish ones are there already."""
    rows = layers.append_raw(raw_rows(spark, sf_dir)).withColumn("canonical_key", F.col("source_ref"))
    return layers.insert_working(rows, rows.filter("uf = 'es'").select("canonical_key").distinct()).select("canonical_key", "id", F.col("version").cast("long").alias("version"))


_CRITERIA_SQL = f"""SELECT r.*, CASE WHEN source IN ('src0','src1','src2') THEN 100.0 ELSE 60.0 END AS origin, least(100.0, floor(n_chars / 20.0)) AS completeness,
 CASE WHEN version > 1 THEN 80.0 ELSE 20.0 END AS corroboration, CAST(id % 101 AS DOUBLE) AS recency, CASE WHEN quality = 1 THEN 100.0 ELSE 0.0 END AS human
 FROM (SELECT * FROM ({VERSIONS_SQL}) WHERE superseded_by_id IS NULL) r LEFT JOIN labels l ON l.doc_id = r.id"""


@query(
    f"""WITH s AS (SELECT uf, CASE WHEN floor((origin * 30.0 / 100.0 + completeness * 20.0 / 100.0 + corroboration * 20.0 / 100.0 + recency * 15.0 / 100.0 + human * 15.0 / 100.0) * 100 + 0.5) / 100 >= 80 THEN 'mar' ELSE 'dlq' END AS routing FROM ({_CRITERIA_SQL}))
SELECT u.uf AS uf, d.routing AS routing, CAST(count(s.uf) AS BIGINT) AS n FROM (SELECT DISTINCT uf FROM s) u CROSS JOIN (VALUES ('pending'), ('mar'), ('dlq'), ('descarte')) d(routing) LEFT JOIN s ON s.uf = u.uf AND s.routing = d.routing GROUP BY 1, 2"""
)
def reliability_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: raw versions, active rows, five criteria, score, route, and counts over all four routes per block."""
    rows = layers.active(layers.append_raw(raw_rows(spark, sf_dir)))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    scored = rows.join(labels, "id", "left").select(
        "uf",
        F.when(F.col("source").isin("src0", "src1", "src2"), 100.0).otherwise(60.0).alias("origin"),
        F.least(F.lit(100.0), F.floor(F.col("n_chars") / 20.0)).alias("completeness"),
        F.when(F.col("version") > 1, 80.0).otherwise(20.0).alias("corroboration"),
        (F.col("id") % 101).cast("double").alias("recency"),
        F.when(F.col("quality") == 1, 100.0).otherwise(0.0).alias("human"),
    )
    score, _ = reliability()
    counts = scored.withColumn("routing", route(score)).groupBy("uf", "routing").agg(F.count("*").alias("n"))
    wide = counts.groupBy("uf").pivot("routing", ROUTES).agg(F.sum("n"))
    return wide.select("uf", F.explode(F.array(*(F.struct(F.lit(r).alias("routing"), F.coalesce(r, F.lit(0)).cast("long").alias("n")) for r in ROUTES))).alias("x")).select("uf", "x.routing", "x.n")


@query(f"SELECT o_orderkey, score, routing, origin * 30.0 / 100.0 AS origin_points, human * 15.0 / 100.0 AS human_points FROM ({SCORED_SQL})")
def score_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_orders(spark, sf_dir).select("o_orderkey", "score", "routing", F.col("breakdown.origin").alias("origin_points"), F.col("breakdown.human").alias("human_points"))


@query(f"SELECT o_orderkey, 'v1.0' AS score_version, CASE WHEN routing = 'dlq' THEN 'score=' || printf('%.2f', score) || ' below threshold_mar=80.0' END AS dlq_reason FROM ({SCORED_SQL})")
def route_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scored_orders(spark, sf_dir)
    return d.select("o_orderkey", F.lit("v1.0").alias("score_version"), F.when(F.col("routing") == "dlq", F.format_string("score=%.2f below threshold_mar=80.0", "score")).alias("dlq_reason"))


@query(
    f"""SELECT count(*) AS n, floor(sum(CASE WHEN routing = 'mar' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*) * 100 + 0.5) / 100 AS mar_pct, floor(sum(CASE WHEN routing = 'dlq' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*) * 100 + 0.5) / 100 AS dlq_pct,
 floor(avg(score) * 100 + 0.5) / 100 AS mean, floor(stddev_samp(score) * 100 + 0.5) / 100 AS stdev FROM ({SCORED_SQL})"""
)
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.distribution(scored_orders(spark, sf_dir), "score", "routing")


@query(
    f"""WITH c AS (SELECT o_custkey AS source_ref, o_orderkey AS id, score, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM ({SCORED_SQL}) WHERE routing = 'mar')
SELECT n.source_ref AS source_ref, n.content AS content, CAST(coalesce(a.version, 0) + 1 AS BIGINT) AS version FROM (SELECT c_custkey AS source_ref, c_mktsegment AS content FROM customer) n
LEFT JOIN (SELECT source_ref, version, CASE WHEN source_ref % 3 = 0 THEN (SELECT c_mktsegment FROM customer WHERE c_custkey = source_ref) ELSE 'old' END AS content FROM c WHERE nxt IS NULL) a ON a.source_ref = n.source_ref WHERE a.content IS DISTINCT FROM n.content"""
)
def promote_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are the candidates, their promoted orders the canonical versions; a third hold the same content already."""
    d = scored_orders(spark, sf_dir).filter("routing = 'mar'").select(F.col("o_custkey").alias("source_ref"), F.col("o_orderkey").alias("id"), "o_orderdate")
    candidates = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_ref"), F.col("c_mktsegment").alias("content"))
    chain = layers.version_chain(d, ["source_ref"], ["o_orderdate", "id"]).join(candidates, "source_ref", "left")
    chain = chain.withColumn("content", F.when(F.col("source_ref") % 3 == 0, F.col("content")).otherwise("old"))
    return layers.promote(candidates, chain).select("source_ref", "content", F.col("version").cast("long").alias("version"))


@query(f"SELECT source_ref, stage, status, id FROM ({EVENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY source_ref, stage, status ORDER BY created_at, id) = 1")
def events_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.append_once(event_rows(spark, sf_dir), None, ["source_ref", "stage", "status"], ["created_at", "id"]).select("source_ref", "stage", "status", "id")


@query(f"SELECT count(*) AS n FROM (SELECT DISTINCT source_ref, stage, status FROM ({EVENTS_SQL}) WHERE id % 2 = 1 EXCEPT SELECT source_ref, stage, status FROM ({EVENTS_SQL}) WHERE id % 2 = 0)")
def events_append_once_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_rows(spark, sf_dir)
    return layers.append_once(e.filter("id % 2 = 1"), e.filter("id % 2 = 0"), ["source_ref", "stage", "status"], ["created_at", "id"]).agg(F.count("*").alias("n"))


@query(f"SELECT status, count(*) AS n FROM ({EVENTS_SQL}) WHERE NOT (status <> 'fail' AND created_at < TIMESTAMP '2024-01-16 00:00:00') GROUP BY 1")
def events_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = layers.retain(event_rows(spark, sf_dir), F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    return kept.groupBy("status").agg(F.count("*").alias("n"))


@query(f"SELECT stage, id FROM ({EVENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY stage ORDER BY id DESC) <= 500")
def log_ring_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.newest(event_rows(spark, sf_dir), ["stage"], [F.desc("id")], 500).select("stage", "id")


@query(f"SELECT * FROM (SELECT stage, id FROM ({EVENTS_SQL}) WHERE stage = 'view' AND id > 100 ORDER BY id DESC LIMIT 50) ORDER BY id")
def log_tail_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 50 lines after a cursor, in order (the limit is the feature)."""
    return event_rows(spark, sf_dir).filter("stage = 'view' AND id > 100").orderBy(F.desc("id")).limit(50).orderBy("id").select("stage", "id")


@query(
    """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS a FROM conversations) WHERE a = 1
QUALIFY row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) = 1"""
)
def conversation_append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn is appended once by its number and once by its content."""
    c = table(spark, sf_dir, "conversations")
    once = layers.append_once(c, None, ["conv_id", "turn"], ["role", "text"])
    return layers.append_once(once, None, ["conv_id", "role", "text"], ["turn"]).select("conv_id", "turn", "role")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'override' ELSE c_mktsegment END AS value FROM customer")
def config_overlay_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("value"))
    return layers.upsert(base, base.filter("c_custkey % 4 = 0").withColumn("value", F.lit("override")), "c_custkey").select("c_custkey", "value")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'set' ELSE n_name END AS value FROM nation")
def config_seed_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    defaults = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("value"))
    return layers.seed_absent(defaults.filter("n_nationkey % 2 = 0").withColumn("value", F.lit("set")), defaults, "n_nationkey")


@query("SELECT c_custkey, CAST(map_extract(m, 'segment')[1] AS VARCHAR) AS segment, CAST(map_extract(m, 'note')[1] AS VARCHAR) AS note FROM (SELECT c_custkey, MAP {'segment': CASE WHEN c_custkey % 2 = 0 THEN 'CHANGED' ELSE c_mktsegment END, 'note': c_name} AS m FROM customer)")
def merge_key_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concurrent note survives a change of the segment."""
    c = table(spark, sf_dir, "customer")
    current = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("note"), F.col("c_name"))
    before = F.create_map(F.lit("segment"), F.col("c_mktsegment"))
    after = F.create_map(F.lit("segment"), F.when(F.col("c_custkey") % 2 == 0, "CHANGED").otherwise(F.col("c_mktsegment")))
    m = layers.merge_changed(current, before, after)
    return c.select("c_custkey", F.try_element_at(m, F.lit("segment")).alias("segment"), F.try_element_at(m, F.lit("note")).alias("note"))


@query("SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice < 0 OR o_totalprice > 300000 THEN 'price' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END) AS broken FROM orders WHERE o_totalprice < 0 OR o_totalprice > 300000 OR o_orderstatus NOT IN ('F', 'O')")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = layers.quarantine(table(spark, sf_dir, "orders"), {"price": F.col("o_totalprice").between(0, 300000), "status": F.col("o_orderstatus").isin("F", "O")})
    return bad.select("o_orderkey", F.array_join("broken_rules", ",").alias("broken"))


@query(f"SELECT source_ref, version, n FROM (SELECT source_ref, CAST(max(version) AS BIGINT) AS version, count(*) AS n FROM ({VERSIONS_SQL}) GROUP BY 1) WHERE n > 1")
def versions_per_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = layers.append_raw(raw_rows(spark, sf_dir))
    return v.groupBy("source_ref").agg(F.max("version").cast("long").alias("version"), F.count("*").alias("n")).filter("n > 1")


@query(f"SELECT r.id AS id FROM ({RAW_SQL}) r WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.id)")
def unrouted_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(spark, sf_dir).join(table(spark, sf_dir, "labels"), F.col("id") == F.col("doc_id"), "left_anti").select("id")


@query(f"SELECT CAST(c_custkey AS BIGINT) AS source_ref, CASE WHEN u.source_ref IS NOT NULL THEN 'dlq' ELSE 'mar' END AS routing FROM customer LEFT JOIN (SELECT DISTINCT source_ref FROM ({EVENTS_SQL}) WHERE status = 'fail' AND created_at >= TIMESTAMP '{NOW_EVENTS} 00:00:00' - INTERVAL 20 DAY) u ON u.source_ref = c_custkey")
def reopen_from_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical records with a failure reported in the last 20 days go back to review."""
    reports = event_rows(spark, sf_dir).filter((F.col("status") == "fail") & (F.col("created_at") >= F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")))
    reports = reports.select("source_ref").distinct().withColumn("reported", F.lit(True))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_ref"))
    return c.join(reports, "source_ref", "left").select("source_ref", F.when(F.col("reported"), "dlq").otherwise("mar").alias("routing"))
