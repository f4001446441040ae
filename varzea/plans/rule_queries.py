"""Queries of filters, gates, transitions and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions import scalars
from varzea.operators import rules
from varzea.plans.bindings import NOW_EVENTS, SCORED_SQL, event_rows, scored_orders, table
from varzea.plans.registry import query


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2') AND text ILIKE '%tion%'")
def record_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality, membership and case-insensitive contains, AND-composed."""
    return table(spark, sf_dir, "documents").filter((F.col("lang") == "en") & F.col("source").isin("src1", "src2") & F.col("text").ilike("%tion%")).select("doc_id")


@query("SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) = 7 AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'")
def json_and_time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_rows(spark, sf_dir)
    return e.filter((F.col("k") == 7) & F.col("created_at").between(F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))).select(F.col("id").alias("event_id"))


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 HAVING list_contains(list(DISTINCT o_orderstatus), 'P')")
def array_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.collect_set("o_orderstatus").alias("states"))
    return d.filter(F.array_contains("states", "P")).select("o_custkey", "n")


@query(f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'not_in_dlq' WHEN routing = 'mar' THEN 'already_published' WHEN corroboration < 40 THEN 'few_sources' WHEN human > 0 THEN 'has_human' END AS reason FROM ({SCORED_SQL})")
def eligibility_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = rules.first_reason([("not_in_dlq", F.col("o_orderstatus") == "P"), ("already_published", F.col("routing") == "mar"), ("few_sources", F.col("corroboration") < 40), ("has_human", F.col("human") > 0)])
    return scored_orders(spark, sf_dir).select("o_orderkey", reason.alias("reason"))


@query(f"SELECT o_orderkey, bool_and(routing = 'dlq') OVER (PARTITION BY o_custkey) AS moved FROM ({SCORED_SQL})")
def all_or_nothing_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scored_orders(spark, sf_dir).withColumn("reason", F.when(F.col("routing") != "dlq", "published"))
    return rules.all_or_nothing(d, "o_custkey", "reason").select("o_orderkey", "moved")


@query(
    """SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'no_phone' WHEN event_type = 'error' THEN 'quality_red' WHEN value < 5 THEN 'no_legal_basis' WHEN n > 300 THEN 'ramp_cap' END AS gate_reason
FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS n FROM events)"""
)
def compliance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rules.admitted(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), "day", "ts", ["event_id"], 300)
    reason = rules.first_reason([("no_phone", F.col("user_id") % 10 == 0), ("quality_red", F.col("event_type") == "error"), ("no_legal_basis", F.col("value") < 5), ("ramp_cap", ~F.col("admitted"))])
    return e.select("event_id", reason.alias("gate_reason"))


@query("SELECT event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 100 AS admitted FROM events")
def daily_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return rules.admitted(e, "day", "ts", ["event_id"], 100).select("event_id", "admitted")


@query(
    """SELECT event_id, CAST(spent AS BIGINT) AS spent, spent + cents >= 500000 AS blocked FROM (SELECT event_id, cents, coalesce(sum(cents) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM (SELECT *, CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents FROM events))"""
)
def budget_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("day"), F.floor(F.col("value") * 100 + 0.5).alias("cents"))
    return rules.budget_blocked(e, "day", "ts", ["event_id"], "cents", 500000).select("event_id", "spent", "blocked")


@query("SELECT o_orderkey, o_orderdate >= TIMESTAMP '2001-09-01 00:00:00' - INTERVAL 90 DAY AS recent FROM orders")
def recent_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """90 days; null would be false."""
    limit = F.expr("TIMESTAMP_NTZ '2001-09-01 00:00:00' - INTERVAL 90 DAY")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.col("o_orderdate") >= limit, F.lit(False)).alias("recent"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'descarte' WHEN c_acctbal < 1000 THEN 'dlq' ELSE 'mar' END AS routing FROM customer")
def closed_and_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed goes to descarte, stale to dlq, in this order."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.when(F.col("c_acctbal") < 0, "descarte").when(F.col("c_acctbal") < 1000, "dlq").otherwise("mar").alias("routing"))


_STAGES = "CASE {x} % 8 WHEN 0 THEN NULL WHEN 1 THEN 'discovered' WHEN 2 THEN 'signals' WHEN 3 THEN 'contacts' WHEN 4 THEN 'awaiting' WHEN 5 THEN 'approved' WHEN 6 THEN 'rejected' ELSE 'outreach' END"
_EDGE_LIST = ", ".join(f"({'NULL' if a is None else repr(a)}, {b!r})" for a, b in rules.EDGES)


@query(f"SELECT event_id, EXISTS (SELECT 1 FROM (VALUES {_EDGE_LIST}) e(a, b) WHERE e.a IS NOT DISTINCT FROM m.x AND e.b IS NOT DISTINCT FROM m.y) AS allowed FROM (SELECT event_id, {_STAGES.format(x='event_id')} AS x, {_STAGES.format(x='user_id')} AS y FROM events) m")
def stage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.expr(_STAGES.format(x="event_id")).alias("before"), F.expr(_STAGES.format(x="user_id")).alias("after"))
    return rules.edge_allowed(spark, e).select("event_id", "allowed")


@query("SELECT CAST(n_nationkey AS BIGINT) AS config, CASE WHEN n_nationkey % 2 = 0 THEN true ELSE false END AS valid FROM nation")
def weights_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("config"), F.explode(F.array(*map(F.lit, [30.0, 20.0, 20.0, 15.0]))).alias("weight"))
    last = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("config"), F.when(F.col("n_nationkey") % 2 == 0, 15.0).otherwise(16.0).alias("weight"))
    return rules.weights_valid(n.unionByName(last))


@query(f"SELECT o_orderkey, floor((score + (100.0 - human) * 15.0 / 100.0) * 100 + 0.5) / 100 AS score, CASE WHEN floor((score + (100.0 - human) * 15.0 / 100.0) * 100 + 0.5) / 100 >= 80 THEN 'mar' ELSE 'dlq' END AS routing FROM ({SCORED_SQL}) WHERE routing = 'dlq'")
def validate_and_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A person's approval sets that criterion to 100; the record is scored again."""
    d = scored_orders(spark, sf_dir).filter("routing = 'dlq'").withColumn("human", F.lit(100.0)).drop("score", "breakdown", "routing")
    score, _ = scalars.reliability()
    return d.withColumn("score", score).select("o_orderkey", "score", scalars.route(F.col("score")).alias("routing"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'discard' WHEN 'P' THEN 'keep' ELSE 'merge' END AS decision, CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey AS VARCHAR) END AS merged_refs FROM orders")
def dedup_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """discard, keep, or merge: a merge appends the reference to the provenance."""
    o = table(spark, sf_dir, "orders")
    decision = F.when(F.col("o_orderstatus") == "F", "discard").when(F.col("o_orderstatus") == "P", "keep").otherwise("merge")
    refs = F.array_append(F.array(F.col("o_custkey").cast("string")), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", decision.alias("decision"), F.when(decision == "merge", F.array_join(refs, ",")).alias("merged_refs"))


@query("SELECT r_name AS uf, e AS lane, d AS depth FROM region CROSS JOIN (VALUES ('destinations'), ('attractions')) l(e) CROSS JOIN (VALUES (1), (2)) x(d) WHERE NOT (e = 'attractions' AND d = 1)")
def sweep_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch list: every region with each lane and depth that is enabled (exploded, no cross join)."""
    r = table(spark, sf_dir, "region").select(F.col("r_name").alias("uf"))
    plan = r.withColumn("lane", F.explode(F.array(F.lit("destinations"), F.lit("attractions")))).withColumn("depth", F.explode(F.array(F.lit(1), F.lit(2))))
    return plan.filter("NOT (lane = 'attractions' AND depth = 1)")


@query("SELECT conv_id, CAST(count(*) FILTER (role = 'user') AS BIGINT) AS answers, CASE WHEN count(*) FILTER (role = 'user') = 0 THEN 'no_answer' WHEN count(*) FILTER (role = 'user') >= 3 THEN 'confirmed' ELSE 'open' END AS outcome FROM conversations GROUP BY 1")
def owner_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("answers"))
    return n.withColumn("outcome", F.when(F.col("answers") == 0, "no_answer").when(F.col("answers") >= 3, "confirmed").otherwise("open"))


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user' AND turn >= 1 AND NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = conv_id AND toxic = 1)")
def opted_out_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("conv_id")).distinct()
    return table(spark, sf_dir, "conversations").filter("role = 'user' AND turn >= 1").join(out, "conv_id", "left_anti").select("conv_id", "turn")


@query(f"SELECT CAST(user_id AS BIGINT) AS user_id, arg_max(event_type, (ts, event_id)) = 'error' AS red FROM events WHERE ts < TIMESTAMP '{NOW_EVENTS} 00:00:00' GROUP BY 1")
def quality_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last rating decides."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg((F.max_by("event_type", F.struct("ts", "event_id")) == "error").alias("red"))


@query("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN NULL ELSE 'places:' || upper(lang) || ':' || CAST(doc_id AS VARCHAR) END AS source_ref FROM documents")
def failed_payload_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null where the id is missing, empty or unknown."""
    raw = F.when(F.col("doc_id") % 6 == 0, F.lit("")).when(F.col("doc_id") % 6 == 1, F.lit("unknown")).otherwise(F.col("doc_id").cast("string"))
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", raw.alias("raw"))
    return d.select("doc_id", F.when(F.col("raw").isNotNull() & ~F.col("raw").isin("", "unknown"), F.concat(F.lit("places:"), F.upper("lang"), F.lit(":"), F.col("raw"))).alias("source_ref"))


@query("SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 4 = 0 OR s_acctbal <= 0 THEN 0 ELSE least(130, floor(s_acctbal / 1000 / 0.075)) END AS INTEGER) AS n FROM supplier")
def batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remaining budgets, overdrawn and unknown ones among them."""
    left = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_acctbal") / 1000)
    return table(spark, sf_dir, "supplier").select("s_suppkey", scalars.batch_size(130, left).alias("n"))
