"""Queries of logs, consents, runs, batches, retries, settings, landed files and single functions."""

from __future__ import annotations

import atexit
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions import fuzzy, scalars
from varzea.operators import lifecycle as life
from varzea.operators import resolve, rules
from varzea.plans.bindings import EVENTS_SQL, LOCATED_SQL, PLACES_SQL, event_rows, located, places, table
from varzea.plans.record_bindings import NOW, records, records_sql
from varzea.plans.registry import query
from varzea.sources import files, pages

R = f"({records_sql()})"
_now = lambda: F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


@query("SELECT 'route' AS action, c_custkey AS record_id, before, after, 'steward' AS actor FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS before, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS after FROM customer) WHERE before IS DISTINCT FROM after")
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    d = table(spark, sf_dir, "customer").select(F.lit("attraction").alias("entity_type"), k.alias("record_id"), F.when(k % 3 != 0, F.col("c_mktsegment")).alias("before"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("after"), _now().alias("at"))
    return life.audit(d, F.lit("route"), "steward").select("action", "record_id", "before", "after", "actor")


@query(
    """WITH l AS (SELECT c_nationkey * 100 + c_custkey % 40 AS phone, c_custkey AS id, c_custkey % 17 = 0 AS out FROM customer WHERE c_custkey % 3 = 0),
s AS (SELECT phone, bool_or(out) AS out, max(CASE WHEN NOT out THEN id END) AS active FROM l GROUP BY 1),
q AS (SELECT phone, id FROM (SELECT c_nationkey * 100 + c_custkey % 40 AS phone, c_custkey AS id FROM customer WHERE c_custkey % 2 = 0) QUALIFY row_number() OVER (PARTITION BY phone ORDER BY id) = 1)
SELECT q.phone AS phone, q.id AS id, CASE WHEN out THEN 'refused' WHEN active IS NOT NULL THEN 'touched' ELSE 'inserted' END AS outcome, CASE WHEN NOT out THEN active END AS active_id FROM q LEFT JOIN s ON s.phone = q.phone"""
)
def consent_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("phone", F.col("c_nationkey") * 100 + F.col("c_custkey") % 40)
    log = c.filter("c_custkey % 3 = 0").select("phone", F.col("c_custkey").alias("consent_id"), F.col("c_custkey").alias("first_contact"), (F.col("c_custkey") % 17 == 0).alias("opted_out"))
    requests = c.filter("c_custkey % 2 = 0").select("phone", F.col("c_custkey").alias("id"), F.lit(0).alias("at"))
    return life.upsert_consents(requests, log).select("phone", "id", "outcome", "active_id")


@query("SELECT c_nationkey AS phone, bool_or(c_custkey % 7 = 0) OR c_nationkey % 4 = 0 AS opted_out FROM customer WHERE c_nationkey <> 8 GROUP BY 1 UNION ALL SELECT 8, true")
def opt_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a phone are marked, one without rows gets one (nation 8 has none here)."""
    log = table(spark, sf_dir, "customer").filter("c_nationkey <> 8").select(F.col("c_nationkey").alias("phone"), (F.col("c_custkey") % 7 == 0).alias("opted_out"))
    out = table(spark, sf_dir, "nation").filter("n_nationkey % 4 = 0").select(F.col("n_nationkey").alias("phone"))
    some = log.select("phone").distinct().unionByName(spark.createDataFrame([(8,)], "phone int"))
    return life.opt_out(log, out.join(some, "phone", "left_semi")).groupBy("phone").agg(F.bool_or("opted_out").alias("opted_out"))


# Words that opt a contact out, and those that may stand beside one.
_OUT, _FILLER = ["SAIR", "PARAR", "NÃO", "STOP"], ["POR", "FAVOR", "QUERO", "ME", "QUER", "PFV", "PLEASE", "OBRIGADO", "OBRIGADA"]
_TYPED = ["Quero SAIR, por favor!", "quero parar e sair", "nao", "NÃO.", "não sei", "", "por favor", "sair sair", "parar - obrigada", "Stop!!"]


@query(f"SELECT conv_id, turn, list_contains(['SAIR', 'PARAR', 'NÃO', 'NAO', 'STOP'], array_to_string(list_filter(string_split_regex(upper(t), '[^0-9A-ZÀ-ÖØ-Þ]+'), lambda w: w <> '' AND NOT list_contains({_FILLER}, w)), ' ')) AS out FROM (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 3 = 0 THEN {_TYPED}[(conv_id * 7 + turn) % {len(_TYPED)} + 1] ELSE text END AS t FROM conversations)")
def opt_out_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that opt out with and without polite words, replies that only mention such a word, and ordinary turns."""
    c, pick = table(spark, sf_dir, "conversations"), (F.col("conv_id") * 7 + F.col("turn")) % len(_TYPED)
    text = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.get(F.array(*map(F.lit, _TYPED)), pick.cast("int"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", scalars.opt_out_tokens(text, _FILLER, _OUT).alias("out"))


@query("SELECT (SELECT count(*) FROM nation) AS kept, (SELECT count(*) FROM region) AS seeded")
def seed_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = (table(spark, sf_dir, t).select(F.col(f"{t[0]}_name").alias("name")) for t in ("nation", "region"))
    kept, seeded = life.seed_if_empty(n, r), life.seed_if_empty(n.filter("name = 'none'"), r)
    return kept.agg(F.count("*").alias("kept")).join(seeded.agg(F.count("*").alias("seeded")))


@query("SELECT n_nationkey AS code, n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey * 2.5 - 30 END::DOUBLE AS lat FROM nation")
def merged_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names with the old table's positions, written as CSV and read again."""
    p = places(spark, sf_dir).select(F.col("place_code").cast("string").alias("code"), F.col("place_name").alias("name"), F.col("place_lat").alias("lat"), F.col("place_lng").alias("lng"))
    merged = life.merged_places(p.select("code", "name"), p.filter("code % 3 <> 0"))
    path = landed(spark, merged)
    return files.read_csv(spark, path, "code string, name string, lat double, lng double").select(F.col("code").cast("int").alias("code"), "name", "lat")


def landed(spark: SparkSession, rows: DataFrame, kind: str = "csv") -> str:
    """Write rows to a fresh folder of the shared one; it goes when the driver ends."""
    from varzea.streaming.stream_queries import delete_path, shared_dir

    path = f"{shared_dir(spark)}/varzea-landed-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, path)
    if kind == "csv":
        rows.write.csv(path, header=True)
    else:
        rows.write.text(path)
    return path


_RUNS = "SELECT n_nationkey AS run_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(n_nationkey * 20 AS INT)) AS started, CASE WHEN n_nationkey % 5 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(n_nationkey * 20 + n_nationkey * 7 + 3 AS INT)) END AS ended FROM nation"


@query(
    f"""WITH r AS (SELECT *, coalesce(ended, {NOW}) AS until, CASE WHEN ended IS NULL THEN 'executando' WHEN run_id % 3 = 0 THEN 'parcial' ELSE 'concluido' END AS status FROM ({_RUNS})),
f AS (SELECT ts, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS s, CASE WHEN event_type IN ('click', 'error') THEN 1 ELSE 0 END AS f FROM events WHERE event_type IN ('view', 'click', 'error'))
SELECT run_id, status, CAST(coalesce(sum(s), 0) AS BIGINT) AS synced, CAST(coalesce(sum(f), 0) AS BIGINT) AS failed, CAST(coalesce(sum(s + f), 0) AS BIGINT) AS total FROM r LEFT JOIN f ON ts BETWEEN started AND until GROUP BY 1, 2"""
)
def run_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their windows' published, failed and quarantined rows."""
    at = lambda h: F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=h.cast("int"))
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation")
    starts = n.select(k.alias("run_id"), at(k * 20).alias("started"))
    ends = n.filter("n_nationkey % 5 <> 0").select(k.alias("run_id"), at(k * 27 + 3).alias("at"), F.when(k % 3 == 0, "stopping").otherwise("running").alias("state"), k.alias("dispatched"))
    e = event_rows(spark, sf_dir).select(F.col("created_at").alias("at"), "stage")
    runs = life.run_envelopes(starts, ends, _now())
    out = life.run_totals(runs, e.filter("stage = 'view'"), e.filter("stage = 'click'").withColumn("routing", F.lit("dlq")), e.filter("stage = 'error'"))
    return out.select("run_id", "status", "synced", "failed", "total")


@query("SELECT r_regionkey AS run_id, n_name AS uf, lane FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES ('destinations'), ('attractions')) l(lane) WHERE NOT (lane = 'attractions' AND r_regionkey % 2 = 0)")
def rerun_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = F.when(F.col("n_regionkey") % 2 == 0, F.array(F.lit("gone"), F.lit("destinations"))).otherwise(F.array(F.lit("attractions"), F.lit("destinations")))
    runs = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("run_id"), lanes.alias("lanes")).agg(F.collect_list("n_name").alias("ufs"))
    return life.rerun_scope(runs, ["destinations", "attractions"])


_PAGES = "SELECT o_custkey AS listing, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) * 30 AS offset_, o_orderkey AS k FROM orders"


def _ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a page; one page in seven is missing."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("listing"), ((F.row_number().over(w) - 1) * 30).alias("offset"), F.col("o_orderkey").alias("k"))
    return o.filter("k % 7 <> 0").withColumn("cards", F.lit(30)).withColumn("errors", (F.col("k") % 2).cast("int"))


@query(
    f"""WITH p AS ({_PAGES}), m AS (SELECT listing, min(CASE WHEN k % 7 = 0 THEN offset_ END) AS hole, max(offset_) + 30 AS past FROM p GROUP BY 1)
SELECT c_custkey AS listing, CAST(coalesce(hole, past, 0) AS BIGINT) AS next_offset, CAST(coalesce(hole, past, 0) // 30 + 1 AS BIGINT) AS next_page, coalesce(hole, past, 0) // 30 + 1 > 5 AS done FROM customer LEFT JOIN m ON listing = c_custkey"""
)
def ingest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("listing"), F.lit(5).alias("pages"))
    return life.resume(_ingest_pages(spark, sf_dir), total)


@query(
    f"""SELECT c_custkey AS listing, CAST(coalesce(n, 0) AS BIGINT) AS done, CAST(coalesce(n, 0) * 30 AS BIGINT) AS cards, CAST(coalesce(e, 0) AS BIGINT) AS errors, least(100.0, floor(coalesce(n, 0) * 1000.0 / 9 + 0.5) / 10)::DOUBLE AS percent
FROM customer LEFT JOIN (SELECT listing, count(*) AS n, sum(k % 2) AS e FROM ({_PAGES}) WHERE k % 7 <> 0 GROUP BY 1) ON listing = c_custkey"""
)
def progress_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("listing"), F.lit(9).alias("pages"))
    return life.progress(_ingest_pages(spark, sf_dir), total)


_ENGINE = "CASE event_id % 9 WHEN 0 THEN 'start' WHEN 1 THEN 'stop' WHEN 2 THEN 'dispatch' WHEN 3 THEN 'dispatch' WHEN 4 THEN 'dispatch' ELSE 'finish' END"


@query(
    f"""WITH l AS (SELECT user_id AS engine, ts, event_id, {_ENGINE} AS event FROM events),
g AS (SELECT engine, list_reduce(list_prepend(CAST(0 AS BIGINT), list(CAST(CASE event WHEN 'dispatch' THEN 1 WHEN 'finish' THEN -1 ELSE 0 END AS BIGINT) ORDER BY ts, event_id)), lambda a, d: greatest(0, a + d)) AS n, max(CASE WHEN event = 'start' THEN (ts, event_id) END) AS a, max(CASE WHEN event = 'stop' THEN (ts, event_id) END) AS b FROM l GROUP BY 1)
SELECT engine, n AS in_flight, CASE WHEN a IS NULL OR n = 0 THEN 'idle' WHEN b > a THEN 'stopping' ELSE 'running' END AS state FROM g"""
)
def engine_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("engine"), F.col("ts").alias("at"), F.col("event_id").alias("id"), F.expr(_ENGINE).alias("event"))
    return life.engine_states(e)


@query("SELECT conv_id, turn, CASE WHEN turn % 11 = 5 OR (turn % 2 = 1 AND turn % 3 = 1) OR turn >= 3 THEN 'finalize' ELSE 'ask_followup' END AS step, CASE WHEN turn % 11 = 5 THEN 'owner_opted_out' WHEN turn % 2 = 1 AND turn % 3 = 1 THEN 'confirmed' ELSE 'owner_no_answer' END AS outcome FROM conversations")
def conversation_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    out, exists, works = F.when(t % 11 == 5, True), F.when(t % 2 == 1, "sim").otherwise(""), F.when(t % 3 == 1, "temporariamente_fechado")
    return table(spark, sf_dir, "conversations").select("conv_id", t, life.conversation_step(out, exists, works, t).alias("step"), life.owner_outcome(out, exists, works).alias("outcome"))


@query(f"SELECT id, newest_review < {NOW} - INTERVAL 25 HOUR AND batch_id IN ('claiming', 'b2') IS TRUE AND newest_review IS NOT NULL AS freed FROM {R} WHERE batch_id IS NOT NULL AND newest_review IS NOT NULL UNION ALL SELECT id, false FROM {R} WHERE batch_id IS NULL OR newest_review IS NULL")
def batch_reap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims by time alone, batches if they are known to be gone."""
    d = records(spark, sf_dir).withColumn("submitted", F.col("newest_review"))
    return life.reaped(d, spark.createDataFrame([("b2",), ("ambiguous?",)], "batch_id string"), _now()).select("id", "freed")


@query(
    f"""SELECT id, CASE WHEN NOT hit THEN batch_id END AS batch_id, CASE WHEN hit AND id % 4 = 0 THEN 'prose' ELSE description END AS description, coalesce(attempts, 0) + CASE WHEN hit AND id % 4 IN (1, 2) THEN 1 ELSE 0 END AS attempts, coalesce(expiries, 0) + CASE WHEN hit AND id % 4 = 3 THEN 1 ELSE 0 END AS expiries
FROM (SELECT *, coalesce(batch_id = 'b2', false) AS hit FROM {R})"""
)
def batch_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of batch b2 for every record, twice; only records with that stamp take them, once."""
    d = records(spark, sf_dir)
    k = F.col("id") % 4
    r = d.select("id", F.lit("b2").alias("batch_id"), F.when(k == 0, "succeeded").when(k == 1, "succeeded").when(k == 2, "errored").otherwise("expired").alias("type"), F.when(k == 0, "prose").when(k == 1, "").alias("text"))
    return life.collected(d, r.unionByName(r))


@query("SELECT l_orderkey * 10 + l_linenumber AS id, CASE l_linenumber % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN CAST(l_quantity * 15 AS INT) < 500 ELSE false END AS refund FROM lineitem")
def call_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), life.never_billed(F.when(k == 0, "timeout").when(k == 1, "connection").when(k == 2, "status").otherwise("other"), (F.col("l_quantity") * 15).cast("int")).alias("refund"))


@query(
    """SELECT task, CASE WHEN ok THEN 'done' WHEN perm OR f > 3 THEN 'quarantined' ELSE 'retry' END AS outcome, CASE WHEN NOT ok AND NOT perm AND f <= 3 THEN CAST(60 * pow(2, f - 1) AS BIGINT) END AS delay_s
FROM (SELECT l_orderkey AS task, bool_or(l_linestatus = 'F' AND l_linenumber > 2) AS ok, bool_or(l_quantity > 48) AS perm, count(*) FILTER (NOT (l_linestatus = 'F' AND l_linenumber > 2) AND NOT l_quantity > 48) AS f FROM lineitem GROUP BY 1)"""
)
def retry_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tasks, lines as tries."""
    result = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") > 2) & (F.col("l_quantity") > 48), "both").when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") > 2), "ok").when(F.col("l_quantity") > 48, "permanent").otherwise("transient")
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task"), F.explode(F.when(result == "both", F.array(F.lit("ok"), F.lit("permanent"))).otherwise(F.array(result))).alias("result"))
    return life.retry_outcome(d)


@query("SELECT n_nationkey AS scope, CASE WHEN n_nationkey % 3 = 0 THEN 'off' WHEN n_nationkey % 3 = 1 THEN 'on' ELSE 'off' END AS value, n_nationkey % 3 = 2 AS fallback FROM nation")
def validated_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    d = table(spark, sf_dir, "nation").select(k.alias("scope"), F.lit("mode").alias("key"), F.when(k % 3 == 0, "off").when(k % 3 == 1, "on").otherwise("maybe").alias("value"))
    return life.settings(d, {"mode": ["on", "off"], "depth": ["1", "2"]}, {"mode": "off", "depth": "1"}).select("scope", "value", "fallback")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'mtur,' ELSE '' END || 'places' AS sources FROM nation")
def enabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.create_map(F.lit("places"), F.lit(True), F.lit("mtur"), F.col("n_nationkey") % 2 == 0, F.lit("unknown"), F.lit(True))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(life.enabled(flags, ["tripadvisor", "mtur", "places"]), ",").alias("sources"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'api_TOKEN' ELSE 'threshold' END AS key, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '***' ELSE '' END ELSE c_name END AS value FROM customer")
def config_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return life.config_snapshot(table(spark, sf_dir, "customer").select(k, F.when(k % 3 == 0, "api_TOKEN").otherwise("threshold").alias("key"), F.when((k % 3 != 0) | (k % 2 == 0), F.col("c_name")).otherwise("").alias("value")))


@query(
    """SELECT event_id AS id, CAST(spent AS BIGINT) AS spent, spent + usd < 200000 AS passes FROM (SELECT event_id, usd, coalesce(sum(usd) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM (SELECT *, CAST(floor(value * 10 + 0.5) AS BIGINT) AS usd FROM events))"""
)
def tracked_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("at"), F.to_date("ts").alias("day"), F.floor(F.col("value") * 10 + 0.5).alias("usd"))
    return life.tracked_calls(e, "day", 200000).select("id", "spent", "passes")


@query("SELECT event_id, coalesce(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 80 AS admitted FROM events")
def ramp_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rejected message gives its place of the day back."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return rules.admitted(e, "day", "ts", ["event_id"], 80, F.col("event_type") == "error").select("event_id", "admitted")


@query(f"SELECT stage, count(*) AS n, (SELECT count(*) FROM events WHERE event_type <> 'view') AS total FROM ({EVENTS_SQL}) WHERE stage <> 'view' GROUP BY 1 ORDER BY 1 LIMIT 2 OFFSET 1")
def paged_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of groups beside the count of all rows of the filter (the page is the feature)."""
    e = event_rows(spark, sf_dir).filter("stage <> 'view'")
    n = e.groupBy("stage").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.orderBy("stage").offset(1).limit(2).join(total)


@query("SELECT p_brand, count(*) * (count(*) - 1) // 2 AS candidates FROM part GROUP BY 1")
def pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs of a block would be compared, from counts alone."""
    return resolve.pair_candidates(table(spark, sf_dir, "part"), ["p_brand"])


@query(
    f"SELECT id, place_code, floor(km * 1000 + 0.5) / 1000 AS km FROM (SELECT id, place_code, 2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) AS km, region FROM (SELECT *, pow(sin(radians(place_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(place_lat)) * pow(sin(radians(place_lng - lng) / 2), 2) AS a, nation % 5 AS region FROM ({LOCATED_SQL}) CROSS JOIN ({PLACES_SQL})) WHERE place_region = region) WHERE km <= 400 QUALIFY row_number() OVER (PARTITION BY id ORDER BY km, place_code) = 1"
)
def nearest_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = located(spark, sf_dir).withColumn("region", F.col("nation") % 5)
    found = resolve.nearest_place(d, places(spark, sf_dir), "id", 400.0, "region")
    return found.select("id", "place_code", (F.floor(F.col("km") * 1000 + 0.5) / 1000).alias("km"))


@query()
def best_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand as search results for parts of the same type (Indel ratios: tested against every pair)."""
    p = table(spark, sf_dir, "part")
    rows = p.filter("p_size % 5 = 0").select(F.col("p_partkey").alias("id"), "p_brand", F.col("p_name").alias("name"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lng"))
    candidates = p.filter("p_size % 5 <> 0").select("p_brand", F.col("p_partkey").alias("position"), F.col("p_name").alias("other"), F.when(F.col("p_partkey") % 2 == 0, F.lit(40.0)).alias("c_lat"), F.lit(1.0).alias("c_lng"))
    return resolve.best_match(rows, candidates, "p_brand", "id", "name", "other", 60.0, 100.0).select("id", "position", "ratio")


@query()
def token_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three ratios of a part's name with its container and type (Indel ratios: tested against a plain version)."""
    a, b = F.col("p_name"), F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", fuzzy.token_sort_ratio(a, b).alias("sort"), fuzzy.token_set_ratio(a, b).alias("set"), fuzzy.partial_token_set_ratio(a, b).alias("partial"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN 'Rua ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS address, lower(c_mktsegment) || ' d agua' AS squeezed, c_mktsegment || 'dagua' AS bare, CASE WHEN c_custkey % 2 = 0 THEN 'BA' END AS uf, CASE WHEN c_custkey % 3 = 0 THEN '@h' || c_custkey END AS handle, CASE WHEN c_custkey % 5 <> 0 THEN '***' ELSE '' END AS redacted FROM customer")
def address_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("c_mktsegment")
    raw = F.when(k % 5 != 0, F.concat(F.lit(" rua "), s, F.lit(" "))).otherwise("  ")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://instagram.com/h"), k.cast("string"), F.lit("/?x"))).otherwise("https://example.com/h")
    return table(spark, sf_dir, "customer").select(
        k, scalars.normalize_address(raw).alias("address"), scalars.squeeze_alnum(F.concat(s, F.lit(" --d'Água!"))).alias("squeezed"), scalars.strip_apostrophes(F.concat(s, F.lit("d’a'gua"))).alias("bare"),
        scalars.state_to_uf(F.when(k % 2 == 0, "State of  Bahía").otherwise("Nowhere")).alias("uf"), scalars.instagram_handle(url).alias("handle"), scalars.redact(F.trim(raw)).alias("redacted"),
    )


@query("SELECT p_partkey, CASE WHEN p_size <= 15 THEN 100 WHEN p_size <= 40 THEN 50 ELSE 0 END::DOUBLE AS recency, CASE p_size % 4 WHEN 0 THEN 25 WHEN 1 THEN 50 WHEN 2 THEN 75 ELSE 90 END::DOUBLE AS steps, CASE p_size % 3 WHEN 0 THEN 4 WHEN 1 THEN 1 END AS price, CASE WHEN p_size % 2 = 0 THEN round(p_retailprice / 7, 6) END AS coordinate FROM part")
def review_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    ages = F.when(s <= 40, F.array(s * 2, s * 2 + 10, F.lit(None))).otherwise(F.array(F.lit(500)))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.recency_of_reviews(ages).alias("recency"), scalars.completeness_steps(s % 4).alias("steps"), scalars.price_level(F.when(s % 3 == 0, "PRICE_LEVEL_VERY_EXPENSIVE").when(s % 3 == 1, "PRICE_LEVEL_INEXPENSIVE").otherwise("x")).alias("price"), F.when(s % 2 == 0, scalars.coordinate(F.col("p_retailprice") / 7)).alias("coordinate"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'cache' WHEN c_custkey % 3 = 0 THEN 'table' WHEN c_custkey % 2 = 1 THEN 'seed' END AS value FROM customer")
def first_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    of = lambda where, v: c.filter(where).withColumn("value", F.lit(v))
    return files.first_known(c, "c_custkey", "value", of("c_custkey % 4 = 0", "cache"), of("c_custkey % 3 = 0", "table"), of("c_custkey % 2 = 1", "seed"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 60 <= 30 THEN c_mktsegment END AS place, c_custkey % 3 <> 2 AND c_custkey % 60 <= 30 AS known FROM customer")
def geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached answers, null ones, and entries older than 30 days."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    cache = c.filter("c_custkey % 3 <> 2").select(k, F.lit("").alias("municipality"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("city"), *(F.lit(None).cast("string").alias(x) for x in ("town", "village", "county")), (_now() - F.make_interval(days=k.cast("int") % 60)).alias("cached_at"))
    return files.geocode(c.select(k), cache, "c_custkey", _now()).select("c_custkey", "place", "known")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS place FROM customer")
def address_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda kind, text: F.struct(F.array(F.lit("political"), F.lit(kind)).alias("types"), text.alias("long_text"))
    k = F.col("c_custkey")
    both = F.array(part("country", F.lit("Brasil")), part("administrative_area_level_2", F.col("c_mktsegment")), part("administrative_area_level_2", F.lit("second")))
    d = table(spark, sf_dir, "customer").select(k, F.when(k % 3 != 2, both).otherwise(F.array(part("country", F.lit("Brasil")))).alias("components"))
    return d.select("c_custkey", files.component("components", "administrative_area_level_2").alias("place"))


@query("SELECT n_nationkey, n_name AS name FROM nation WHERE n_nationkey % 4 <> 0")
def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    d = table(spark, sf_dir, "nation").select(k, F.when(k % 4 == 0, "Total").otherwise("29.0").alias("uf"), F.concat((F.lit(2900000) + k).cast("string"), F.lit(".0")).alias("code"), F.col("n_name").alias("name"))
    return files.sheet_rows(d).select("n_nationkey", "name")


@query("SELECT n_nationkey, n_name AS municipality, n_regionkey AS region, CASE n_regionkey WHEN 0 THEN 'Turistico' WHEN 1 THEN 'Complementar' ELSE 'Apoio' END AS label FROM nation")
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities, districts and categories from CSV, joined by code."""
    n = table(spark, sf_dir, "nation").withColumn("code", F.col("n_nationkey").cast("string"))
    m = files.municipalities(spark, landed(spark, n.select(F.concat(F.lit(" "), F.col("code"), F.lit(" ")).alias("ibge_code"), F.col("n_name").alias("nome"), F.lit("BA").alias("uf"), F.lit(-12.5).alias("lat"), F.lit(-38.5).alias("lng"))))
    d = files.districts(spark, landed(spark, n.select(F.concat("code", F.lit("05")).alias("distrito_code"), F.col("n_regionkey").cast("string").alias("nome"), F.col("code").alias("ibge_code"), F.col("n_name").alias("municipio_nome"), F.lit("BA").alias("uf"))))
    letter = F.when(F.col("n_regionkey") == 0, "A").when(F.col("n_regionkey") == 1, "d").otherwise("E")
    c = files.categories(spark, landed(spark, n.select(F.col("code").alias("co_municipio"), F.col("n_name").alias("no_municipio"), F.lit("BA").alias("sg_uf"), letter.alias("categoria"), F.lit("r").alias("no_regiao_turistica"))))
    out = m.join(d.select("ibge_code", F.col("nome").alias("region")), "ibge_code").join(c.select(F.col("co_municipio").alias("ibge_code"), "label"), "ibge_code")
    return out.select(F.col("ibge_code").cast("int").alias("n_nationkey"), F.col("nome").alias("municipality"), F.col("region").cast("int").alias("region"), "label")


@query("SELECT n_name AS uf, CAST(n_nationkey + 300000 AS BIGINT) AS geo_id FROM nation")
def geo_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object of all rows, as the source lands it."""
    rows = {r["n_name"]: r["n_nationkey"] + 300000 for r in table(spark, sf_dir, "nation").collect()}  # 25 states: a small file by its nature
    return files.geo_ids(spark, landed(spark, spark.createDataFrame([(json.dumps(rows),)], "value string"), "text"))


@query("SELECT o_custkey AS listing, o_orderkey AS id FROM (SELECT *, min(CASE WHEN o_orderkey % 7 = 0 THEN r END) OVER (PARTITION BY o_custkey) AS stop FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders)) WHERE (stop IS NULL OR r < stop) AND o_orderkey % 5 <> 0")
def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of one card; a page without cards ends a listing, a card without id is passed over."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    k = F.col("o_orderkey")
    card = F.struct(F.lit("n").alias("name"), F.when(k % 5 != 0, k).alias("locationId"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("listing"), ((F.row_number().over(w) - 1) * 30).alias("offset"), F.when(k % 7 == 0, F.array().cast(f"array<struct<name:string,locationId:{dict(table(spark, sf_dir, 'orders').dtypes)['o_orderkey']}>>")).otherwise(F.array(card)).alias("cards"))
    path = landed(spark, o.select(F.to_json(F.struct("listing", "offset", "cards")).alias("value")), "text")
    return files.listing_pages(spark, path).select(F.col("listing").cast("long").alias("listing"), F.col("locationId").alias("id"))


@query("SELECT c_custkey AS page_id, '{\"id\":' || c_custkey || ',\"in\":[{\"id\":' || (c_custkey + 1) || '}]}' AS body, 2 AS nodes FROM customer WHERE c_custkey % 3 <> 0")
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON in a page's script and how many objects of it have an id; a third of the pages have none."""
    k = F.col("c_custkey")
    body = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"in":[{"id":'), (k + 1).cast("string"), F.lit("}]}"))
    html = F.when(k % 3 != 0, F.concat(F.lit('<html><script>var a = 1; window.state = "'), F.url_encode(body), F.lit('";</script></html>'))).otherwise("<html><script>x</script></html>")
    d = pages.json_island(table(spark, sf_dir, "customer").select(k.alias("page_id"), html.alias("html")), "window.state")
    found = pages.find_nodes(d, "page_id", "body", pages.has_key("id")).groupBy("page_id").agg(F.count("*").cast("int").alias("nodes"))
    return d.join(found, "page_id").select("page_id", "body", "nodes")


@query(
    """SELECT c_custkey AS page_id, u.id AS location_id, u.name AS name, u.rating AS rating, CAST(u.n AS INTEGER) AS review_count, u.category AS category FROM (SELECT c_custkey, unnest(list_filter([
 {'id': c_custkey, 'name': c_name, 'rating': CASE WHEN c_custkey % 3 = 0 THEN 4.5::DOUBLE ELSE 0.0::DOUBLE END, 'n': CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 ELSE 0 END, 'category': CASE WHEN c_custkey % 5 = 0 THEN 'Praia' ELSE '' END},
 {'id': CASE WHEN c_custkey % 4 <> 0 THEN c_custkey + 1000000 END, 'name': 'inner é "q"', 'rating': 3.0::DOUBLE, 'n': 7, 'category': ''}], lambda x: x.id IS NOT NULL)) AS u FROM customer)"""
)
def flex_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards in nested sections, some inside a string that holds JSON; some without a rating, a category, or an id."""
    k, kind = F.col("c_custkey"), pages.CARD_TYPE
    bubble = F.when(k % 3 == 0, F.struct(F.lit(4.5).alias("rating"), (k % 100).alias("reviewCount")))
    link = lambda value: F.struct(F.struct(F.struct(value.alias("detailId")).alias("typedParams")).alias("webRoute"))
    section = lambda *fields: F.struct(F.lit(kind).alias("__typename"), F.struct(*fields).alias("singleFlexCardContent"))
    outer = section(F.struct(F.col("c_name").alias("text")).alias("cardTitle"), link(k.cast("string")).alias("cardLink"), bubble.alias("bubbleRating"), F.when(k % 5 == 0, F.struct(F.lit("Praia").alias("text"))).alias("primaryInfo"))
    inner = section(F.struct(F.lit('inner é "q"').alias("text")).alias("cardTitle"), link(F.when(k % 4 != 0, k + 1000000)).alias("cardLink"), F.struct(F.lit(3.0).alias("rating"), F.lit(7).alias("reviewCount")).alias("bubbleRating"))
    chunk = F.to_json(F.struct(F.array(F.struct(F.lit("Other").alias("__typename"), F.array(inner).alias("in"))).alias("sections")))
    body = F.to_json(F.struct(F.struct(F.array(outer).alias("list"), F.array(F.struct(chunk.alias("payload"))).alias("chunks"), F.lit("{no json").alias("odd")).alias("data")))
    return pages.flex_cards(table(spark, sf_dir, "customer").select(k.alias("page_id"), body.alias("body")), "page_id", "body").select("page_id", "location_id", "name", "rating", "review_count", "category")


@query("SELECT source, count(*) AS n, true AS sound FROM documents GROUP BY 1")
def cold_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated score inputs of new sources, one for each document of a source, all in their ranges."""
    d = files.cold_start_samples(table(spark, sf_dir, "documents").select("source"), 70.0)
    ranges = F.col("completeness").between(60, 100) & F.col("recency").between(0, 50) & (F.col("origin") == 70) & (F.col("corroboration") == 0)
    return d.groupBy("source").agg(F.count("*").alias("n"), F.bool_and(ranges).alias("sound"))
