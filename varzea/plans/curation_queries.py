"""Queries of what people and agents do to records, over customers, orders, parts and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions import scalars
from varzea.operators import curation, insights, layers
from varzea.operators import records as rec
from varzea.plans.bindings import LOCATED_SQL, PLACES_SQL, SCORED_SQL, located, places, scored_orders, table
from varzea.plans.record_bindings import SCORE, records, records_sql
from varzea.plans.registry import query

R = f"({records_sql()})"
_now = lambda: F.lit("2024-01-31 00:00:00").cast("timestamp")

_KM = "2 * 6371.0 * atan2(sqrt({a}), sqrt(1 - {a}))".format(a="(pow(sin(radians(place_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(place_lat)) * pow(sin(radians(place_lng - lng) / 2), 2))")
_CARDS = f"SELECT id, 'card ' || id AS name, CASE WHEN id % 5 = 0 THEN '' ELSE 'beach' END AS category, CAST(id % 700 AS INT) AS reviews, CASE WHEN id % 9 <> 0 THEN lat END AS lat, lng, nation % 5 AS uf FROM ({LOCATED_SQL})"
_CORROBORATION = "CASE WHEN reviews <= 0 THEN 0.0 ELSE floor(least(100.0, 100.0 * ln(1 + reviews::DOUBLE) / ln(501.0)) * 100 + 0.5) / 100 END::DOUBLE"


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    return located(spark, sf_dir).select(k, F.concat(F.lit("card "), k.cast("string")).alias("name"), F.when(k % 5 == 0, "").otherwise("beach").alias("category"), (k % 700).cast("int").alias("reviews"), F.when(k % 9 != 0, F.col("lat")).alias("lat"), "lng", (F.col("nation") % 5).alias("uf"))


@query(
    f"""WITH c AS ({_CARDS}), p AS ({PLACES_SQL}), near AS (SELECT id, place_code, place_region FROM (SELECT c.id AS id, place_code, place_region, {_KM} AS km FROM c CROSS JOIN p) WHERE km <= 50 QUALIFY row_number() OVER (PARTITION BY id ORDER BY km, place_code) = 1)
SELECT c.id AS id, CASE WHEN place_code IS NOT NULL THEN 'tripadvisor:attraction:' || c.id END AS source_ref, CAST(place_region AS BIGINT) AS uf, place_code AS municipio_id, CASE WHEN place_code IS NOT NULL THEN {_CORROBORATION} END AS corroboration, CASE WHEN place_code IS NULL THEN 'ibge_unmatched' END AS reason FROM c LEFT JOIN near ON near.id = c.id"""
)
def ingest_attractions_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards at the nearest seat of any region; some lie far off or nowhere."""
    good, bad = curation.ingest_attractions(_cards(spark, sf_dir), places(spark, sf_dir))
    return good.select("id", "source_ref", "uf", "municipio_id", "corroboration", F.lit(None).cast("string").alias("reason")).unionByName(bad, allowMissingColumns=True)


@query(
    f"""WITH c AS ({_CARDS}), p AS ({PLACES_SQL}), near AS (SELECT id, place_code, place_region FROM (SELECT c.id AS id, uf, place_code, place_region, {_KM} AS km FROM c CROSS JOIN p) WHERE km <= 50 AND place_region = uf QUALIFY row_number() OVER (PARTITION BY id ORDER BY km, place_code) = 1)
SELECT c.id AS id, CASE WHEN place_code % 3 <> 0 THEN 'ibge:' || place_region || ':' || place_code END AS parent_source_ref, CASE WHEN place_code IS NULL THEN 'ibge_unmatched' WHEN place_code % 3 = 0 THEN 'parent_destino_absent' END AS reason FROM c LEFT JOIN near ON near.id = c.id"""
)
def ingest_attractions_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of a region; every third seat has no destination yet."""
    p = places(spark, sf_dir)
    parents = p.filter("place_code % 3 <> 0").select(F.concat(F.lit("ibge:"), F.col("place_region").cast("string"), F.lit(":"), F.col("place_code").cast("string")).alias("source_ref"))
    good, bad = curation.ingest_attractions(_cards(spark, sf_dir), p, parents)
    return good.select("id", "parent_source_ref", F.lit(None).cast("string").alias("reason")).unionByName(bad, allowMissingColumns=True)


_CONFIRMED = "NOT out AND says = 'sim' AND works IN ('sim', 'temporariamente_fechado')"
_HUMAN = SCORE.replace("human", "100.0")


@query(
    f"""WITH a AS (SELECT *, id % 7 = 0 AS out, CASE WHEN id % 3 = 0 THEN 'sim' WHEN id % 3 = 1 THEN 'nao' END AS says, CASE WHEN id % 2 = 0 THEN 'sim' WHEN id % 5 = 0 THEN 'nao' ELSE 'temporariamente_fechado' END AS works FROM {R}),
o AS (SELECT *, id % 4 <> 3 AS heard, coalesce({_CONFIRMED}, false) AS ok FROM a)
SELECT id, CASE WHEN heard AND ok THEN 100.0::DOUBLE ELSE human END AS human, CASE WHEN heard AND ok THEN {_HUMAN} ELSE score END AS score, CASE WHEN heard AND NOT ok THEN 'dlq' WHEN heard THEN CASE WHEN {_HUMAN} >= 80 THEN 'mar' ELSE 'dlq' END ELSE routing END AS routing,
 CASE WHEN heard AND out THEN 'owner_opted_out' WHEN heard AND NOT ok THEN 'owner_no_answer' END AS dlq_reason, CASE WHEN heard AND ok AND id % 6 = 0 THEN '9-17' END AS owner_hours FROM o"""
)
def owner_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opt-outs, half answers, confirmations, and records that nobody asked about."""
    k = F.col("id")
    d = records(spark, sf_dir)
    works = F.when(k % 2 == 0, "sim").when(k % 5 == 0, "nao").otherwise("temporariamente_fechado")
    answers = d.filter("id % 4 <> 3").select("id", (k % 7 == 0).alias("opted_out"), F.when(k % 3 == 0, "sim").when(k % 3 == 1, "nao").alias("exists"), works.alias("works"), F.when(k % 6 == 0, "9-17").otherwise("").alias("hours"), F.lit(None).cast("string").alias("price"))
    return curation.finalized(d, answers).select("id", "human", "score", "routing", "dlq_reason", "owner_hours")


@query(
    """WITH e AS (SELECT user_id, event_id, ts, '{"kind": "' || event_type || '", "name": null}' AS payload FROM events), h AS (SELECT *, sha256(payload) AS content_hash FROM e QUALIFY row_number() OVER (PARTITION BY user_id, payload ORDER BY ts, event_id) = 1)
SELECT user_id, event_id, content_hash, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM h QUALIFY lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL"""
)
def manual_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves of a record under its reference; what a reader gets is the last version."""
    e = table(spark, sf_dir, "events")
    entries = e.select(F.concat(F.lit("manual:"), F.col("user_id").cast("string")).alias("source_ref"), "user_id", F.col("event_id").alias("id"), F.col("ts").alias("ingested_at"), F.struct(F.lit(None).cast("string").alias("name"), F.col("event_type").alias("kind")).alias("payload"))
    return layers.active(curation.manual_versions(entries)).select("user_id", F.col("id").alias("event_id"), "content_hash", F.col("version").cast("long").alias("version"))


@query(
    f"""SELECT id, coalesce(CASE WHEN id % 2 = 0 THEN 'new' END, name, '-') AS name, CASE WHEN id % 2 = 0 AND entity_type <> 'attraction' THEN '+55' WHEN phone IS NOT NULL THEN phone ELSE '-' END AS phone, CASE WHEN id % 2 = 0 THEN 'x' END AS further FROM {R}"""
)
def edited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second record gets a name, a phone (that attractions do not take) and a further field."""
    d = records(spark, sf_dir).withColumn("normalized", F.create_map(F.lit("name"), F.coalesce("name", F.lit("-")), F.lit("phone_e164"), F.coalesce("phone", F.lit("-"))))
    edits = d.filter("id % 2 = 0").select("id", F.create_map(F.lit("name"), F.lit("new"), F.lit("phone_e164"), F.lit("+55"), F.lit("further"), F.lit("x")).alias("fields"))
    out, get = curation.edited(d, edits), lambda k: F.try_element_at("normalized", F.lit(k))
    return out.select("id", get("name").alias("name"), get("phone_e164").alias("phone"), get("further").alias("further"))


@query(
    f"""SELECT id, '{{"custom_id":"' || id || '","params":{{"model":"m","max_tokens":2048,"system":"s","messages":[{{"role":"user","content":"Nome: ' || coalesce(name, '') || '\\nLocal: ' || coalesce(municipio, '') || '/' || uf || CASE WHEN website IS NOT NULL THEN '\\nEndereço: ' || website ELSE '' END || '"}}]}}}}' AS line FROM {R}"""
)
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.batch_request(records(spark, sf_dir).withColumn("address", F.col("website")), "m", "s")


_WEIGHTS = ["origin", "completeness", "corroboration", "recency", "human"]


@query(
    """SELECT scope, key, before, after FROM (SELECT n_nationkey AS scope, unnest(CASE n_nationkey % 6 WHEN 0 THEN [{'k': 'score.threshold', 'b': '80', 'a': '75'}] WHEN 1 THEN [{'k': 'weight.origin', 'b': '30', 'a': '25'}, {'k': 'weight.human', 'b': '15', 'a': '20.0'}] END) AS u FROM nation WHERE n_nationkey % 6 < 2), LATERAL (SELECT u.k AS key, u.b AS before, u.a AS after)"""
)
def config_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A threshold, weights that still add up; and refused as a whole: weights that do not, a text, a number out of range, an unknown key."""
    k = F.col("n_nationkey")
    row = lambda key, value: F.struct(F.lit(key).alias("key"), F.lit(value).alias("value"))
    scopes = table(spark, sf_dir, "nation").select(k.alias("scope"))
    now = [row(f"weight.{w}", v) for w, v in zip(_WEIGHTS, ("30", "20", "20", "15", "15"))] + [row("score.threshold", "80")]
    current = scopes.select("scope", F.explode(F.array(*now)).alias("x")).select("scope", "x.*")
    wanted = [[row("score.threshold", "75")], [row("weight.origin", "25"), row("weight.human", "20.0")], [row("weight.origin", "29")], [row("score.threshold", "high"), row("weight.human", "15")], [row("score.threshold", "101")], [row("weight.other", "1")]]
    asked = F.array(*map(lambda x: F.array(*x), wanted))
    updates = scopes.select("scope", F.explode(F.get(asked, (F.col("scope") % 6).cast("int"))).alias("x")).select("scope", "x.*")
    numbers = {f"weight.{w}": (0, 100) for w in _WEIGHTS} | {"score.threshold": (0, 100)}
    _, audit, _ = curation.config_update(current, updates, numbers, {"weights": [f"weight.{w}" for w in _WEIGHTS]})
    return audit.select("scope", "key", "before", "after")


@query("SELECT n_nationkey AS scope, CASE n_nationkey % 6 WHEN 2 THEN 'weights_sum' WHEN 5 THEN 'unknown_key' ELSE 'not_in_range' END AS reason FROM nation WHERE n_nationkey % 6 >= 2")
def config_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation")
    current = n.select(k.alias("scope"), F.explode(F.array(*map(F.lit, ["a", "b"]))).alias("key")).withColumn("value", F.lit("50"))
    key = F.when(k % 6 == 5, "c").otherwise("a")
    value = F.when(k % 6 == 0, "50.0").when(k % 6 == 1, "50").when(k % 6 == 2, "49").when(k % 6 == 3, "").otherwise("-1")
    updates = n.select(k.alias("scope"), key.alias("key"), value.alias("value"))
    return curation.config_update(current, updates, {"a": (0, 100), "b": (0, 100)}, {"w": ["a", "b"]})[2]


@query(
    """SELECT count(*) AS runs, CAST(sum(s) AS BIGINT) AS synced, CAST(sum(f) AS BIGINT) AS failed, CAST(floor(sum(s) * 100.0::DOUBLE / (sum(s) + sum(f)) + 0.5) AS BIGINT) AS pct FROM (SELECT CASE WHEN event_type = 'view' THEN event_id % 5 ELSE 0 END AS s, event_id % 3 AS f FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND event_id % 17 <> 0)"""
)
def recent_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the last seven days, of those whose start can be read."""
    k = F.col("event_id")
    runs = table(spark, sf_dir, "events").select(F.when(k % 17 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("started_at"), F.when(F.col("event_type") == "view", k % 5).otherwise(0).alias("synced"), (k % 3).alias("failed"))
    return curation.run_metrics(curation.recent_runs(runs, _now()))


@query("SELECT c_nationkey AS nation, CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS usd, CAST(row_number() OVER (ORDER BY sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) DESC, c_nationkey) AS INT) AS place FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def costs_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs, the dearest first."""
    d = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return curation.by_cost(d.groupBy(F.col("c_nationkey").alias("nation")).agg(F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5)).alias("usd")), "nation")


@query(f"SELECT o_orderkey, origin * 30.0 / 100.0 AS origin, human * 15.0 / 100.0 AS human, CASE WHEN o_orderkey % 3 = 0 THEN 'v2' ELSE 'v1.0' END AS version, o_custkey AS raw_id FROM ({SCORED_SQL})")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a canonical row comes from: points, version of the score, raw and working row."""
    d = scored_orders(spark, sf_dir).withColumn("version", F.when(F.col("o_orderkey") % 3 == 0, "v2"))
    p = rec.provenance("breakdown", "version", "o_custkey", "o_orderkey")
    return d.select("o_orderkey", p.alias("p")).select("o_orderkey", "p.score_breakdown.origin", "p.score_breakdown.human", F.col("p.score_version").alias("version"), F.col("p.nascente_id").alias("raw_id"))


_STATES = ["discovered", "signals", "contacts", "awaiting", "approved", "rejected"]


@query(f"SELECT s.sub_state AS sub_state, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT unnest({_STATES}) AS sub_state) s LEFT JOIN (SELECT sub_state, count(*) AS n FROM {R} WHERE entity_type = 'attraction' GROUP BY 1) c ON c.sub_state = s.sub_state")
def attractions_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six states, also those that no attraction is in."""
    d = records(spark, sf_dir).filter("entity_type = 'attraction' AND sub_state IS NOT NULL")
    return insights.zero_filled(insights.count_by(d, "sub_state"), "sub_state", _STATES)


_IMAGES = "SELECT o_custkey AS id, substr(o_orderpriority, 1, 1) AS tier, o_orderstatus AS source, CASE WHEN o_orderkey % 4 <> 0 THEN 'CC-' || o_orderkey % 3 END AS license, CAST(floor(o_totalprice) AS BIGINT) % 20000 AS url FROM orders WHERE o_custkey % 3 <> 1"


@query(
    f"""WITH r AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 2 = 0 THEN 'db' ELSE 'control' END AS cohort FROM customer), i AS ({_IMAGES}), a AS (SELECT cohort, count(*)::DOUBLE AS total FROM r GROUP BY 1),
per AS (SELECT cohort, coalesce(n, 0) AS n, coalesce(sources, 'none') AS sources FROM r LEFT JOIN (SELECT id, count(*) AS n, string_agg(DISTINCT source, '+' ORDER BY source) AS sources FROM i GROUP BY 1) x ON x.id = r.id),
c AS (SELECT 'tier' AS part, cohort, tier AS item, count(DISTINCT i.id) AS n FROM i JOIN r ON r.id = i.id GROUP BY ALL UNION ALL SELECT 'sources', cohort, sources, count(*) FROM per GROUP BY ALL
 UNION ALL SELECT 'coverage', cohort, 'enough', count(*) FROM per WHERE n >= 3 GROUP BY ALL UNION ALL SELECT 'coverage', cohort, CASE WHEN n > 0 THEN 'any' ELSE 'none' END, count(*) FROM per GROUP BY ALL)
SELECT part, c.cohort AS cohort, item, n, floor(n * 10000 / total + 0.5) / 10000 AS share FROM c JOIN a ON a.cohort = c.cohort
UNION ALL SELECT 'license', NULL, source || ': ' || coalesce(license, '-'), count(*), NULL FROM i JOIN r ON r.id = i.id GROUP BY ALL
UNION ALL SELECT 'reused', NULL, url::VARCHAR, count(DISTINCT i.id), NULL FROM i JOIN r ON r.id = i.id GROUP BY url HAVING count(DISTINCT i.id) > 1"""
)
def image_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pictures of customers: tiers, coverage, combinations of sources, licences and pictures used twice."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") % 2 == 0, "db").otherwise("control").alias("cohort"))
    images = table(spark, sf_dir, "orders").filter("o_custkey % 3 <> 1").select(F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("tier"), F.col("o_orderstatus").alias("source"), F.when(k % 4 != 0, F.concat(F.lit("CC-"), (k % 3).cast("string"))).alias("license"), (F.floor("o_totalprice") % 20000).cast("string").alias("url"))
    return curation.image_report(rows, images)


@query("SELECT event_id AS call_id, floor(((event_id % 900) * 3.0::DOUBLE + (event_id % 50) * 15.0::DOUBLE) * CASE WHEN event_id % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END / 1e6 * 1e9 + 0.5) / 1e9 AS usd FROM events WHERE event_id % 10 <> 3")
def usage_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that the log has not, each once though it is reported twice, with their cost."""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select(k.alias("call_id"), F.col("ts").alias("at"), (k % 900).alias("tokens_in"), (k % 50).alias("tokens_out"), *(F.lit(0).alias(c) for c in ("cache_write", "cache_read", "searches")), (k % 2 == 0).alias("batch"))
    known = e.filter("call_id % 10 = 3").select("call_id")
    return curation.usage_rows(e.unionByName(e.filter("call_id % 4 = 0")), known).select("call_id", (F.floor(F.col("usd") * 1e9 + 0.5) / 1e9).alias("usd"))


@query("SELECT o_custkey AS query, CAST(row_number() OVER w AS INT) AS position, o_orderkey AS place_id, CASE WHEN o_orderkey % 3 <> 0 THEN 'm' || o_orderkey % 7 END AS municipality, CASE WHEN o_orderkey % 3 = 1 THEN 'BA' END AS uf, CASE WHEN o_orderkey % 5 = 0 THEN 'd' || o_orderkey % 11 ELSE '' END AS district FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey) QUALIFY row_number() OVER w <= 20")
def search_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as answers of a search for a customer, twenty at most as the service gives them, with their address read."""
    from pyspark.sql import Window as W

    k = F.col("o_orderkey")
    part = lambda kind, text, short: F.struct(F.array(F.lit("political"), F.lit(kind)).alias("types"), text.alias("long_text"), F.lit(short).cast("string").alias("short_text"))
    name = lambda p, n: F.concat(F.lit(p), (k % n).cast("string"))
    country = part("country", F.lit("Brasil"), "BR")
    parts = [(k % 5 == 0, part("administrative_area_level_3", name("d", 11), None)), (k % 5 == 0, part("administrative_area_level_3", F.lit("second"), None)), (k % 3 != 0, part("administrative_area_level_2", F.lit("first"), None)), (k % 3 != 0, part("administrative_area_level_2", name("m", 7), None)), (k % 3 == 1, part("administrative_area_level_1", F.lit("Bahia"), "BA"))]
    components = F.filter(F.array(country, *(F.when(c, x) for c, x in parts)), lambda x: x.isNotNull())
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).alias("position"))
    o = o.select(F.col("o_custkey").alias("query"), "position", k.alias("place_id"), components.alias("components"))
    return curation.search_results(o)


_NEW = "floor((origin * 25.0 / 100.0 + completeness * 20.0 / 100.0 + corroboration * 20.0 / 100.0 + recency * 15.0 / 100.0 + human * 20.0 / 100.0) * 100 + 0.5) / 100"


@query(f"SELECT id, score, CASE WHEN score >= 60 THEN 'mar' ELSE 'dlq' END AS routing, 'v1.1' AS score_version, CASE WHEN score < 60 THEN 'score=' || printf('%.2f', score) || ' below threshold_mar=60.0' END AS dlq_reason FROM (SELECT id, {_NEW} AS score FROM {R})")
def reprocessed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records under other weights and a lower threshold, twice: the second time changes nothing."""
    config = scalars.ScoreConfig(origin=25.0, human=20.0, threshold=60.0, version="v1.1")
    d = curation.reprocessed(curation.reprocessed(records(spark, sf_dir), config), config)
    return d.select("id", "score", "routing", "score_version", "dlq_reason")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 101 ELSE 0 END::DOUBLE AS origem, CASE WHEN c_custkey % 4 = 0 THEN 12.5 ELSE 0 END::DOUBLE AS completude, 0.0::DOUBLE AS atualidade FROM customer")
def score_inputs_of_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria that are numbers, words, null or not there."""
    k = F.col("c_custkey")
    payload = F.create_map(F.lit("origem_value"), F.when(k % 3 == 0, (k % 101).cast("string")).when(k % 3 == 1, "high"), F.lit("completude_value"), F.when(k % 4 == 0, "1.25e1").otherwise(""), F.lit("name"), F.lit("7"))
    d = table(spark, sf_dir, "customer").select(k, curation.score_input(payload).alias("s"))
    return d.select("c_custkey", F.col("s.origem_value").alias("origem"), F.col("s.completude_value").alias("completude"), F.col("s.atualidade_value").alias("atualidade"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'fail' ELSE 'skip' END AS status, 'dlq' AS routing, 2 - event_id % 2 AS fields FROM events WHERE event_id % 5 < 3 AND event_id % 7 <> 0")
def record_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stage: an unknown status and a missing reference are refused, personal data stays out."""
    k = F.col("event_id")
    status = F.when(k % 5 == 0, "ok").when(k % 5 == 1, "fail").when(k % 5 == 2, "skip").when(k % 5 == 3, "done")
    data = F.when(k % 2 == 0, F.create_map(F.lit("routing"), F.lit("dlq"), F.lit("score"), F.lit("7"), F.lit("phone"), F.lit("+55"))).otherwise(F.create_map(F.lit("routing"), F.lit("dlq"), F.lit("email"), F.lit("x@y")))
    e = table(spark, sf_dir, "events").select(k, F.lit("tripadvisor").alias("source"), F.when(k % 7 != 0, F.concat(F.lit("ref"), k.cast("string"))).otherwise("").alias("source_ref"), F.lit("ingested").alias("stage"), status.alias("status"), F.lit(None).cast("string").alias("message"), data.alias("data"))
    return curation.record_events(e)[0].select("event_id", "status", F.col("data")["routing"].alias("routing"), F.size("data").cast("long").alias("fields"))
