"""Analytical queries: volumes, rates, costs, funnels, conversations, runs, timelines, paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.scalars import llm_cost
from varzea.operators import insights, scans
from varzea.plans.bindings import EVENTS_SQL, NOW_EVENTS, ROUTES, SCORED_SQL, event_rows, scored_orders, table
from varzea.plans.registry import query

_ROUTE_VALUES = ", ".join(f"('{r}')" for r in ROUTES)


@query(f"SELECT d.routing AS routing, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (VALUES {_ROUTE_VALUES}) d(routing) LEFT JOIN (SELECT routing, count(*) AS n FROM ({SCORED_SQL}) GROUP BY 1) c ON c.routing = d.routing")
def layer_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.zero_filled(insights.count_by(scored_orders(spark, sf_dir), "routing"), "routing", ROUTES)


@query("SELECT count(*) AS all_versions, count(DISTINCT o_custkey) AS active FROM orders")
def canonical_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions, and active ones only."""
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("all_versions"), F.count_distinct("o_custkey").alias("active"))


@query(f"SELECT stage, n, floor(n / (sum(n) OVER ())::DOUBLE * 10000 + 0.5) / 10000 AS rate FROM (SELECT stage, count(*) AS n FROM ({EVENTS_SQL}) WHERE created_at >= TIMESTAMP '{NOW_EVENTS} 00:00:00' - INTERVAL 168 HOUR GROUP BY 1)")
def action_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.expr(f"TIMESTAMP_NTZ '{NOW_EVENTS} 00:00:00' - INTERVAL 168 HOUR")
    return insights.action_rates(event_rows(spark, sf_dir).filter(F.col("created_at") >= since), "stage")


@query(f"SELECT count(*) AS throughput, CAST(count(*) FILTER (status = 'fail') AS BIGINT) AS failures, CAST(count(*) FILTER (stage = 'purchase') AS BIGINT) AS published FROM ({EVENTS_SQL}) WHERE created_at >= TIMESTAMP '{NOW_EVENTS} 00:00:00' - INTERVAL 240 HOUR")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_rows(spark, sf_dir).filter(F.col("created_at") >= F.expr(f"TIMESTAMP_NTZ '{NOW_EVENTS} 00:00:00' - INTERVAL 240 HOUR"))
    return e.agg(F.count("*").alias("throughput"), F.count_if(F.col("status") == "fail").alias("failures"), F.count_if(F.col("stage") == "purchase").alias("published"))


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("lane"), F.col("l_linestatus").alias("model"), F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("usd"), F.col("l_quantity").cast("long").alias("prompt_tokens"), F.col("l_linenumber").cast("long").alias("completion_tokens"))


_COST_SQL = "SELECT {k} AS {a}, CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS usd, CAST(sum(CAST(l_quantity AS BIGINT) + l_linenumber) AS BIGINT) AS tokens, count(*) AS calls FROM lineitem GROUP BY 1"


@query(_COST_SQL.format(k="l_returnflag", a="lane"))
def cost_by_lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """usd is in cents, so that sums are exact."""
    return insights.costs(_generations(spark, sf_dir), "lane")


@query(_COST_SQL.format(k="l_linestatus", a="model"))
def cost_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.costs(_generations(spark, sf_dir), "model")


@query(f"SELECT lane, usd, floor(usd::DOUBLE * 100 / (sum(usd::DOUBLE) OVER ()) * 100 + 0.5) / 100 AS share_pct, floor(greatest(2.0, usd::DOUBLE * 100 / (max(usd::DOUBLE) OVER ())) * 100 + 0.5) / 100 AS bar_pct FROM ({_COST_SQL.format(k='l_returnflag', a='lane')})")
def cost_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.cost_shares(insights.costs(_generations(spark, sf_dir), "lane")).select("lane", "usd", "share_pct", "bar_pct")


@query("SELECT CAST(sum(usd) AS BIGINT) AS usd, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(calls) AS BIGINT) AS calls FROM (" + _COST_SQL.format(k="l_returnflag", a="lane") + ")")
def cost_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = insights.costs(_generations(spark, sf_dir), "lane")
    return c.agg(F.sum("usd").alias("usd"), F.sum("tokens").alias("tokens"), F.sum("calls").alias("calls"))


@query(
    "SELECT l_orderkey, l_linenumber, floor(((l_quantity * 1000 * 3.0::DOUBLE + l_linenumber * 3.0::DOUBLE * 1.25::DOUBLE + 7 * 3.0::DOUBLE * 0.1::DOUBLE + l_quantity * 15.0::DOUBLE) * (CASE WHEN l_returnflag = 'R' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) / 1000000.0::DOUBLE + 2 * 0.01::DOUBLE) * 1000000 + 0.5) / 1000000 AS usd FROM lineitem"
)
def generation_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    usd = llm_cost(F.col("l_quantity") * 1000, F.col("l_quantity"), F.col("l_linenumber"), F.lit(7), F.lit(2), F.col("l_returnflag") == "R")
    return li.select("l_orderkey", "l_linenumber", (F.floor(usd * 1000000 + 0.5) / 1000000).alias("usd"))


@query(
    f"""SELECT 'ingested' AS block, source AS a, lang AS b, count(*) AS n FROM documents WHERE source = 'src0' GROUP BY 2, 3 UNION ALL SELECT 'routing', routing, CAST(nation AS VARCHAR), count(*) FROM ({SCORED_SQL}) GROUP BY 2, 3 UNION ALL SELECT 'published', NULL, NULL, count(*) FROM ({SCORED_SQL}) WHERE routing = 'mar'"""
)
def funnel_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three aggregates in one table; the source filter touches the first block only."""
    d, s = table(spark, sf_dir, "documents"), scored_orders(spark, sf_dir)
    first = d.filter("source = 'src0'").groupBy("source", "lang").agg(F.count("*").alias("n")).select(F.lit("ingested").alias("block"), F.col("source").alias("a"), F.col("lang").alias("b"), "n")
    second = s.groupBy("routing", "nation").agg(F.count("*").alias("n")).select(F.lit("routing").alias("block"), F.col("routing").alias("a"), F.col("nation").cast("string").alias("b"), "n")
    third = s.filter("routing = 'mar'").agg(F.count("*").alias("n")).select(F.lit("published").alias("block"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), "n")
    return first.unionByName(second).unionByName(third)


@query("SELECT user_id % 20 AS bucket, " + ", ".join(f"CAST(count(*) FILTER (event_type = '{s}') AS BIGINT) AS \"{s}\"" for s in ("view", "click", "signup", "purchase", "error")) + " FROM events GROUP BY 1")
def stage_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = ["view", "click", "signup", "purchase", "error"]
    wide = event_rows(spark, sf_dir).groupBy((F.col("source_ref") % 20).alias("bucket")).pivot("stage", stages).agg(F.count("id"))
    return wide.select("bucket", *(F.coalesce(s, F.lit(0)).cast("long").alias(s) for s in stages))


@query("SELECT conv_id, count(*) AS messages, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY 1")
def conversation_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("messages"), F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role"))


@query("SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last_outbound, CAST(count(*) FILTER (role = 'user') AS BIGINT) AS inbound FROM conversations GROUP BY 1")
def last_outbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_outbound"), F.count_if(F.col("role") == "user").alias("inbound"))


@query(f"SELECT k, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM ({EVENTS_SQL}) WHERE status = 'fail' GROUP BY 1")
def failures_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = event_rows(spark, sf_dir).filter("status = 'fail'").groupBy("k").agg(F.count("*").alias("n"))
    return n.withColumn("total", F.sum("n").over(W.partitionBy()))


@query("SELECT coalesce(CAST(quality AS VARCHAR), 'none') AS sub_state, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def children_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy(F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("sub_state")).agg(F.count("*").alias("n"))


@query(f"SELECT source_ref, id, k FROM ({EVENTS_SQL}) WHERE status = 'fail' QUALIFY row_number() OVER (PARTITION BY source_ref ORDER BY created_at DESC, id) = 1")
def latest_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.latest(event_rows(spark, sf_dir).filter("status = 'fail'"), "source_ref", [F.desc("created_at"), F.asc("id")]).select("source_ref", "id", "k")


@query(f"SELECT e.id AS id, e.source_ref AS source_ref FROM ({EVENTS_SQL}) e JOIN (SELECT source_ref, max(created_at) AS m FROM ({EVENTS_SQL}) GROUP BY 1) l ON l.source_ref = e.source_ref AND l.m = e.created_at")
def events_at_latest_moment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_rows(spark, sf_dir)
    return e.withColumn("_m", F.max("created_at").over(W.partitionBy("source_ref"))).filter("created_at = _m").select("id", "source_ref")


@query(f"SELECT source_ref, arg_max(k, (created_at, id)) FILTER (k IS NOT NULL) AS last_k, arg_max(id, (created_at, id)) FILTER (status = 'fail') AS last_failure FROM ({EVENTS_SQL}) GROUP BY 1")
def last_known_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_rows(spark, sf_dir).select("source_ref", "created_at", "id", F.col("k").alias("last_k"), F.when(F.col("status") == "fail", F.col("id")).alias("last_failure"))
    return insights.last_known(e, "source_ref", ["created_at", "id"], ["last_k", "last_failure"])


@query(
    f"""SELECT source_ref, min(id) AS first, max(id) AS last, any_value(stage) AS stage, count(*) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY source_ref ORDER BY id) AS i FROM (SELECT source_ref, id, stage, CASE WHEN lag(stage) OVER (PARTITION BY source_ref ORDER BY id) = stage THEN 0 ELSE 1 END AS c FROM ({EVENTS_SQL}))) GROUP BY source_ref, i"""
)
def stage_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.runs_of_equal(event_rows(spark, sf_dir), "source_ref", "id", "stage")


@query("SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM lineitem")
def running_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.sum(F.col("l_quantity").cast("long")).over(w).alias("running"))


@query(
    """SELECT r.o_custkey AS o_custkey, CAST(count(o.o_orderkey) AS BIGINT) AS total, CAST(count(o.o_orderkey) FILTER (o.o_orderstatus = 'F') AS BIGINT) AS synced, CAST(count(o.o_orderkey) FILTER (o.o_orderstatus <> 'F') AS BIGINT) AS failed
FROM (SELECT o_custkey, min(o_orderdate) + INTERVAL 100 DAY AS started, max(o_orderdate) AS ended FROM orders GROUP BY 1) r LEFT JOIN orders o ON o.o_custkey = r.o_custkey AND o.o_orderdate BETWEEN r.started AND r.ended GROUP BY 1"""
)
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is a customer's span of orders without its first 100 days; facts inside count."""
    o = table(spark, sf_dir, "orders")
    runs = o.groupBy("o_custkey").agg((F.min("o_orderdate") + F.expr("INTERVAL 100 DAY")).alias("started"), F.max("o_orderdate").alias("ended")).withColumn("run_id", F.col("o_custkey"))
    done = (F.col("o_orderstatus") == "F").cast("long")
    facts = o.select("o_custkey", F.col("o_orderdate").alias("at"), F.lit(1).cast("long").alias("total"), done.alias("synced"), (1 - done).alias("failed"))
    n = scans.interval_sums(runs, facts, "run_id", ["total", "synced", "failed"], ["o_custkey"])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return runs.select("run_id", "o_custkey").join(n, "run_id", "left").select("o_custkey", zero("total"), zero("synced"), zero("failed"))


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS done, least(100.0::DOUBLE, floor(count(*)::DOUBLE / 20 * 100 + 0.5)) AS pct FROM orders GROUP BY 1")
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("done"))
    return d.withColumn("pct", F.least(F.lit(100.0), F.floor(F.col("done").cast("double") / 20 * 100 + 0.5)))


@query("SELECT CAST(ts AS DATE)::VARCHAR AS day, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS spent, count(*) AS calls FROM events GROUP BY 1")
def daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.sum(F.floor(F.col("value") * 100 + 0.5)).alias("spent"), F.count("*").alias("calls"))


@query("SELECT DISTINCT source FROM documents WHERE source NOT IN ('src0', 'src1')")
def distinct_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(~F.col("source").isin("src0", "src1")).select("source").distinct()


@query("SELECT sources, count(*) AS n FROM (SELECT lang, quality, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2) GROUP BY 1")
def source_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    sets = d.groupBy("lang", "quality").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return sets.groupBy("sources").agg(F.count("*").alias("n"))


@query("SELECT p_type, min(p_size)::BIGINT AS least, CAST((list(p_size ORDER BY p_size))[len(list(p_size)) // 2 + 1] AS BIGINT) AS median, max(p_size)::BIGINT AS most FROM part GROUP BY 1")
def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median is the upper one of an even count. Ranked by a window, so no group is gathered in one row."""
    w = W.partitionBy("p_type")
    d = table(spark, sf_dir, "part").select("p_type", "p_size", F.row_number().over(w.orderBy("p_size")).alias("i"), F.count("*").over(w).alias("n"))
    return d.groupBy("p_type").agg(F.min("p_size").cast("long").alias("least"), F.max(F.when(F.col("i") == F.floor(F.col("n") / 2) + 1, F.col("p_size"))).cast("long").alias("median"), F.max("p_size").cast("long").alias("most"))


@query(
    """SELECT p_partkey, (a + b + c)::DOUBLE / 3 AS mean_rank FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS a, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS b, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS c FROM part)"""
)
def engagement_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of three ranks within a brand's parts."""
    d, w = table(spark, sf_dir, "part"), W.partitionBy("p_brand")
    ranks = [F.row_number().over(w.orderBy(*o)) for o in ((F.desc("p_size"), "p_partkey"), (F.desc("p_retailprice"), "p_partkey"), ("p_name", "p_partkey"))]
    return d.select("p_partkey", ((ranks[0] + ranks[1] + ranks[2]) / F.lit(3.0)).alias("mean_rank"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50")
def paged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.page(table(spark, sf_dir, "orders"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 50, 25).select("o_orderkey", "o_custkey")


@query(f"SELECT user_id AS source_ref, CAST(min(event_id) FILTER (event_type = 'error') AS BIGINT) AS first_error, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1 ORDER BY first_error DESC NULLS LAST, source_ref LIMIT 40")
def board_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A board's top 40 by a nullable key, nulls last."""
    d = event_rows(spark, sf_dir).groupBy("source_ref").agg(F.min(F.when(F.col("status") == "fail", F.col("id"))).alias("first_error"), F.count("*").alias("n"))
    return d.orderBy(F.desc_nulls_last("first_error"), "source_ref").limit(40)


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 5")
def capped_per_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap per block is the feature."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return d.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("doc_id"))).filter("n <= 5").drop("n")


@query("SELECT DISTINCT lang FROM documents ORDER BY 1")
def distinct_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("lang").distinct().orderBy("lang")


@query("SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def monitor_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "event_type").agg(F.count("*").alias("n"))
