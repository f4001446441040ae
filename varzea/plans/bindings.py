"""The entities of the curation layers over the driver's tables.

raw: documents, 60 references per source so that they have versions; working: scored orders; events: events;
conversations as they are; places: nations (seats with made-up coordinates), customers as rows to be placed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions.scalars import ScoreConfig, reliability, route

#: the moment that queries take as now, right after the tables' ranges
NOW_ORDERS, NOW_EVENTS = "2001-09-01", "2024-01-31"
ROUTES = ["pending", "mar", "dlq", "descarte"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"), "source", F.concat(F.col("source"), F.lit(":"), F.col("lang"), F.lit(":"), (F.col("doc_id") % 60).cast("string")).alias("source_ref"),
        F.lit("document").alias("entity_type"), F.col("lang").alias("uf"), F.sha2("text", 256).alias("content_hash"), F.col("doc_id").alias("ingested_at"), F.length("text").cast("long").alias("n_chars"),
    )


RAW_SQL = """SELECT doc_id AS id, source, source || ':' || lang || ':' || CAST(doc_id % 60 AS VARCHAR) AS source_ref, 'document' AS entity_type, lang AS uf,
 sha256(text) AS content_hash, doc_id AS ingested_at, CAST(length(text) AS BIGINT) AS n_chars FROM documents"""

VERSIONS_SQL = f"""SELECT *, row_number() OVER w AS version, lead(id) OVER w AS superseded_by_id FROM (
 SELECT * FROM ({RAW_SQL}) QUALIFY row_number() OVER (PARTITION BY source, source_ref, content_hash ORDER BY ingested_at, id) = 1)
 WINDOW w AS (PARTITION BY source, source_ref ORDER BY ingested_at, id)"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the five criteria, score and routing."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    age = F.date_diff(F.to_date(F.lit(NOW_ORDERS)), F.to_date("o_orderdate"))
    d = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(c.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"), "left")
    d = d.select(
        "o_orderkey", "o_custkey", F.col("c_nationkey").cast("long").alias("nation"), "o_orderdate", "o_orderstatus",
        (100.0 - (priority - 1) * 10).alias("origin"),
        (F.when(F.col("c_custkey").isNotNull(), 50.0).otherwise(0.0) + F.when(F.col("n_lines").isNotNull(), 50.0).otherwise(0.0)).alias("completeness"),
        F.least(F.lit(100.0), F.coalesce("n_lines", F.lit(0)) * 20.0).alias("corroboration"),
        F.when(age <= 365, 100.0).when(age <= 730, 70.0).when(age <= 1460, 40.0).otherwise(20.0).alias("recency"),
        F.when(F.col("o_orderstatus") == "F", 100.0).when(F.col("o_orderstatus") == "P", 50.0).otherwise(0.0).alias("human"),
    )
    score, breakdown = reliability(ScoreConfig())
    return d.withColumn("score", score).withColumn("breakdown", breakdown).withColumn("routing", route(F.col("score")))


SCORED_SQL = f"""SELECT *, CASE WHEN score >= 80 THEN 'mar' ELSE 'dlq' END AS routing FROM (
 SELECT *, floor((origin * 30.0 / 100.0 + completeness * 20.0 / 100.0 + corroboration * 20.0 / 100.0 + recency * 15.0 / 100.0 + human * 15.0 / 100.0) * 100 + 0.5) / 100 AS score FROM (
 SELECT o_orderkey, o_custkey, CAST(c_nationkey AS BIGINT) AS nation, o_orderdate, o_orderstatus,
  CAST(100.0 - (CAST(substr(o_orderpriority, 1, 1) AS INT) - 1) * 10 AS DOUBLE) AS origin,
  CAST(CASE WHEN c_custkey IS NOT NULL THEN 50 ELSE 0 END + CASE WHEN n_lines IS NOT NULL THEN 50 ELSE 0 END AS DOUBLE) AS completeness,
  CAST(least(100, coalesce(n_lines, 0) * 20) AS DOUBLE) AS corroboration,
  CAST(CASE WHEN age <= 365 THEN 100 WHEN age <= 730 THEN 70 WHEN age <= 1460 THEN 40 ELSE 20 END AS DOUBLE) AS recency,
  CAST(CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'P' THEN 50 ELSE 0 END AS DOUBLE) AS human
 FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '{NOW_ORDERS}') AS age FROM orders)
 LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey))"""


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record events: a reference's stages, failures being errors; `k` comes from the JSON."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("source_ref"), F.col("event_type").alias("stage"), F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("status"),
        F.col("ts").alias("created_at"), "value", F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


EVENTS_SQL = """SELECT event_id AS id, user_id AS source_ref, event_type AS stage, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END AS status, ts AS created_at, value,
 TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(key.cast("long").alias("place_code"), F.col("n_name").alias("place_name"), F.col("n_regionkey").cast("long").alias("place_region"), (key * 2.5 - 30.0).alias("place_lat"), (key * 3.0 - 70.0).alias("place_lng"))


PLACES_SQL = "SELECT CAST(n_nationkey AS BIGINT) AS place_code, n_name AS place_name, CAST(n_regionkey AS BIGINT) AS place_region, CAST(n_nationkey * 2.5 - 30 AS DOUBLE) AS place_lat, CAST(n_nationkey * 3.0 - 70 AS DOUBLE) AS place_lng FROM nation"


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points near their nation's seat, some far off."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"), F.col("c_nationkey").cast("long").alias("nation"), (F.col("c_nationkey") * 2.5 - 30.0 + (k % 7) / 10.0).alias("lat"), (F.col("c_nationkey") * 3.0 - 70.0 + (k % 11) / 10.0).alias("lng")
    )


LOCATED_SQL = "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, CAST(c_nationkey * 2.5 - 30 AS DOUBLE) + (c_custkey % 7) / 10.0::DOUBLE AS lat, CAST(c_nationkey * 3.0 - 70 AS DOUBLE) + (c_custkey % 11) / 10.0::DOUBLE AS lng FROM customer"
