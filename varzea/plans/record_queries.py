"""Queries of projections, gates and stewards' decisions over records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions import scalars
from varzea.operators import enrich, gates, layers
from varzea.operators import records as rec
from varzea.plans.bindings import table
from varzea.plans.record_bindings import AGE, KIND, NOW, SCORE, records, records_sql
from varzea.plans.registry import query

R = f"({records_sql()})"
_now = lambda: F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
_RECENT = f"coalesce(newest_review >= {NOW} - INTERVAL 90 DAY, false)"
_PHONE_PARTS = "CASE WHEN phone LIKE '+55739%' THEN phone END"


@query(
    f"""SELECT id, entity_type, regexp_replace(name, '#', '#') AS name, round(lat, 6) AS lat, round(lon, 6) AS lon, coalesce(score, 0.0)::DOUBLE AS origem_value, 0.0::DOUBLE AS completude_value, municipio, coalesce(municipio_id, ibge_code) AS municipio_id,
 CASE WHEN entity_type = 'attraction' THEN nullif(tipo, '') END AS tipo, entity_type AS label, 'v1.0' AS taxonomy_version FROM {R}"""
)
def working_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload maps with missing keys as working rows."""
    m = {"name": "upper(name)", "lat": "lat", "lng": "lon", "origem_value": "score", "municipio": "municipio", "municipio_id": "municipio_id", "ibge_code": "ibge_code", "tipo": "tipo"}
    payload = F.create_map(*(y for k, v in m.items() for y in (F.lit(k), F.expr(f"CAST({v} AS STRING)"))))
    d = records(spark, sf_dir).select("id", "entity_type", payload.alias("payload"))
    w = rec.working(d)
    return w.select("id", "entity_type", "name", "lat", "lon", "origem_value", "completude_value", "municipio", "municipio_id", "tipo", F.col("labels.entity_type").alias("label"), F.col("labels.taxonomy_version").alias("taxonomy_version"))


@query(
    f"""SELECT id, CASE WHEN entity_type = 'attraction' AND NOT {_RECENT} THEN 'dlq' ELSE 'mar' END AS routing, CASE WHEN entity_type = 'attraction' AND NOT {_RECENT} THEN 'no_recent_reviews' END AS dlq_reason,
 CASE WHEN entity_type = 'attraction' AND NOT {_RECENT} THEN NULL WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 2 ELSE 1 END AS version, CASE WHEN entity_type = 'destination' OR {_RECENT} THEN 'municipio,name' END AS keys FROM {R}"""
)
def promotion_backstop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion with the stale-review backstop and the nine internal keys dropped: a third of the records are canonical already
    with the same content (no new version), a third with other content."""
    m = {"name": "name", "municipio": "municipio", "origem_value": "'1'", "contact": "phone", "google_enriched": "'true'", "most_recent_review_at": "'x'"}
    d = records(spark, sf_dir).withColumn("normalized", F.create_map(*(y for k, v in m.items() for y in (F.lit(k), F.expr(f"CAST({v} AS STRING)")))))
    held = d.filter("id % 3 <> 2").select("source_ref", F.when(F.col("id") % 3 == 0, layers.content_key(rec.canonical_map(F.col("normalized")), F.col("score"))).otherwise("old").alias("content"), F.lit(1).alias("version"), F.lit(None).cast("string").alias("superseded_by_id"))
    return layers.promote_records(d, held, _now()).select("id", "routing", "dlq_reason", "version", F.array_join(F.array_sort(F.map_keys("canonical")), ",").alias("keys"))


@query(f"SELECT id, coalesce(name, '') AS nome, uf, split_part(source_ref, ':', 1) AS fonte, coalesce(score, 0.0)::DOUBLE AS score, routing, coalesce(municipio_id, split_part(source_ref, ':', 3)) AS ibge FROM {R} WHERE entity_type = 'destination'")
def destination_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.destination_listing(records(spark, sf_dir))


@query(f"SELECT id, coalesce(name, '') AS nome, uf, coalesce(tipo, 'outros') AS tipo, coalesce(sub_state, 'none') AS sub_state, coalesce(score, 0.0)::DOUBLE AS score, parent_source_ref FROM {R} WHERE entity_type = 'attraction'")
def attraction_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.attraction_listing(records(spark, sf_dir))


@query(f"SELECT id, website, CASE WHEN phone IS NULL THEN NULL WHEN length(phone) <= 6 THEN '***' ELSE phone[:5] || '*****' || phone[-2:] END AS phone_masked, website IS NULL AND phone IS NULL AS none FROM {R}")
def safe_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = rec.safe_contacts(F.col("website"), F.col("phone"))
    return records(spark, sf_dir).select("id", c.alias("c")).select("id", "c.website", "c.phone_masked", F.col("c").isNull().alias("none"))


@query(f"SELECT id, CASE WHEN p IS NULL THEN NULL WHEN length(p) <= 6 THEN '***' ELSE p[:5] || '*****' || p[-2:] END AS phone FROM (SELECT id, coalesce(nullif(owner_phone, ''), nullif(phone, ''), nullif(website, '')) AS p FROM {R})")
def phone_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("id", rec.first_phone(F.col("owner_phone"), F.col("phone"), F.col("website")).alias("phone"))


@query(f"SELECT id, name, municipio AS municipality, uf, tipo AS type, CAST(score AS VARCHAR) AS rating, 'tripadvisor' AS source FROM {R}")
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = {"name": "name", "addressObj.city": "municipio", "addressObj.state": "uf", "category": "tipo", "rating": "score", "locationId": "id"}
    d = records(spark, sf_dir).select("id", F.create_map(*(y for k, v in m.items() for y in (F.lit(k), F.col(v).cast("string")))).alias("fields"))
    return rec.mapped(d, "tripadvisor", "id").select("id", "name", "municipality", "uf", "type", "rating", "source")


@query(f"SELECT id, entity_type, place_id IS NOT NULL AS has_place, lat IS NOT NULL AND lon IS NOT NULL AS has_position, id % 3 = 0 AS has_hours FROM {R}")
def enriched_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id") % 3
    return rec.domain_view(records(spark, sf_dir).withColumn("weekday_text", F.when(k == 0, F.array(F.lit("Monday: Closed"))).when(k == 1, F.array().cast("array<string>"))))


@query(
    """SELECT id, source, page_url, width, author, license, attribution, views, dist_m FROM (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'commons' WHEN 1 THEN 'mtur' ELSE 'pixabay' END AS source, 'u' || p_partkey AS page_url, p_size AS width,
 CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS author, CASE WHEN p_partkey % 3 = 2 THEN 'Pixabay Content License' ELSE p_type END AS license,
 CASE p_partkey % 3 WHEN 0 THEN 'Foto: ' || CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE 'None' END || ' / ' || p_type WHEN 1 THEN 'Foto: ' || CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE 'None' END ELSE 'by ' || CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE 'None' END || ' via Pixabay' END AS attribution,
 CASE WHEN p_partkey % 3 = 2 THEN p_size * 10 END AS views, CASE WHEN p_partkey % 3 = 0 THEN p_size * 2 END AS dist_m FROM part)"""
)
def image_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources in one shape; the id rides in the url."""
    p = table(spark, sf_dir, "part").withColumn("u", F.concat(F.lit("u"), F.col("p_partkey").cast("string"))).withColumn("by", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))).withColumn("url", F.col("p_partkey").cast("string"))
    of = lambda k: p.filter(F.col("p_partkey") % 3 == k)
    commons = of(0).select("url", F.col("u").alias("descriptionurl"), F.col("p_size").alias("width"), F.lit(1).alias("height"), F.col("by").alias("artist"), F.col("p_type").alias("licenseshortname"), (F.col("p_size") * 2).alias("dist"))
    mtur = of(1).select("url", F.col("u").alias("page_url"), F.col("p_size").alias("width"), F.lit(1).alias("height"), F.col("by").alias("author"), F.col("p_type").alias("license"), F.lit(90).alias("match_confidence"))
    pixabay = of(2).select(F.col("url").alias("largeImageURL"), F.col("u").alias("pageURL"), F.col("p_size").alias("imageWidth"), F.lit(1).alias("imageHeight"), F.col("by").alias("user"), (F.col("p_size") * 10).alias("views"))
    return rec.images(commons, mtur, pixabay).select(F.col("url").cast("long").alias("id"), "source", "page_url", "width", "author", "license", "attribution", "views", "dist_m")


@query("""SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'atrativo' ELSE 'destino' END AS type, 'falha' AS "column", CASE WHEN event_id % 4 = 0 THEN CASE WHEN event_id % 3 = 0 THEN 'ingest_Atrativo' ELSE 'ingest_destino' END ELSE 'ref' || user_id END AS title, CASE WHEN event_id % 5 = 0 THEN '' ELSE props END AS note FROM events WHERE event_type = 'error'""")
def failure_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("event_type = 'error'")
    k = F.col("event_id")
    d = e.select(k.alias("id"), F.when(k % 3 == 0, "ingest_Atrativo").otherwise("ingest_destino").alias("task_name"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("ref"), F.col("user_id").cast("string"))).alias("source_ref"), F.when(k % 5 != 0, F.col("props")).alias("error"))
    return rec.failure_cards(d)


@query(
    f"""SELECT id, concat_ws(chr(10), 'Nome: ' || name, 'Local: ' || municipio || '/' || uf, CASE WHEN id % 2 = 0 THEN 'Tipos: praia, trilha' END, 'Endereço: ' || nullif(website, ''), '- r1', '- r2', '- r3') AS context FROM {R}"""
)
def prompt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    kinds = F.when(k % 2 == 0, F.array(F.lit("praia"), F.lit("trilha"))).otherwise(F.array().cast("array<string>"))
    reviews = F.array(F.lit(None).cast("string"), F.lit("r1"), F.lit(""), F.lit("r2"), F.lit("r3"), F.lit("r4"))
    return records(spark, sf_dir).select("id", rec.prompt_context(F.col("name"), F.col("municipio"), F.col("uf"), kinds, F.col("website"), reviews).alias("context"))


@query(
    f"""SELECT source_ref, entity_type, split_part(source_ref, ':', 1) AS source, CASE WHEN a THEN coalesce(name, '') ELSE coalesce(name, municipio, '') END AS name, CASE WHEN a THEN coalesce(nullif(tipo, ''), 'outros') END AS type,
 i AS municipio_ibge, CASE WHEN a THEN coalesce(owner_phone, {_PHONE_PARTS}) END AS whatsapp, CASE WHEN a AND (phone LIKE '+55733%' OR phone LIKE '+1 %') THEN phone END AS telefone,
 CASE WHEN a THEN coalesce(parent_source_ref, 'ibge:' || uf || ':' || coalesce(i, 'None')) END AS parent, CASE WHEN a AND price_level LIKE 'PRICE%' THEN CASE price_level WHEN 'PRICE_LEVEL_FREE' THEN 0 ELSE 2 END END AS price_level,
 CASE WHEN a AND id % 2 = 0 THEN 'closed' END AS sunday FROM (SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN '+1 491 555 2671' ELSE phone END AS phone), entity_type = 'attraction' AS a, CASE WHEN entity_type = 'attraction' THEN coalesce(municipio_id, ibge_code) ELSE coalesce(ibge_code, municipio_id) END AS i FROM {R})"""
)
def push_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both shapes; every second record has readable hours, every seventh a number of another country."""
    days = "Monday Tuesday Wednesday Thursday Friday Saturday".split()
    week = F.array(*(F.lit(f"{d}: 09:00-17:00") for d in days), F.when(F.col("id") % 2 == 0, "Sunday: Closed").otherwise("Sunday: maybe"))
    d = records(spark, sf_dir).withColumn("phone", F.when(F.col("id") % 7 == 0, "+1 491 555 2671").otherwise(F.col("phone")))
    p = rec.push_payload(d.withColumn("weekday_text", week))
    return p.select("source_ref", "entity_type", "payload.source", "payload.name", "payload.type", "payload.municipio_ibge", "payload.whatsapp", "payload.telefone", F.col("payload.destino.source_ref").alias("parent"), "payload.price_level", F.try_element_at("payload.opening_hours", F.lit("sun")).alias("sunday"))


_GATE = f"""CASE WHEN trim(coalesce(phone, '')) = '' THEN 'contact_phone' WHEN id % 20 = 4 THEN 'legal_basis' WHEN body NOT LIKE '%Norteia%' THEN 'sender' WHEN id % 20 = 8 THEN 'opted_out' WHEN template <> 'hello' THEN 'template'
 WHEN NOT coalesce(window_open, true) THEN 'window' WHEN sub_state IS DISTINCT FROM 'whatsapp_in_progress' THEN 'sub_state' WHEN sent >= 30 THEN 'ramp' WHEN uf = 'PE' THEN 'quality' END"""


@query(f"SELECT id, {_GATE} AS gate_reason FROM (SELECT *, count(*) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sent FROM {R})")
def send_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine conditions in order; the ramp counts the day's earlier messages."""
    from varzea.operators.rules import running

    d = records(spark, sf_dir).withColumn("day", F.lit("d")).withColumn("at", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("id").cast("decimal(18,6)")))
    d = running(d, "day", "at", ["id"], F.lit(1), "sent_today")
    d = d.withColumn("consented", F.when(F.col("id") % 20 != 4, True)).withColumn("opted_out", F.col("id") % 20 == 8).withColumn("quality_red", F.col("uf") == "PE")
    return d.select("id", gates.send_gate(["hello"], 30).alias("gate_reason"))


@query(f"SELECT id FROM {R} WHERE entity_type = 'attraction' AND routing <> 'descarte' AND batch_id IS NULL AND name IS NOT NULL AND description IS NULL AND coalesce(attempts, 0) < 3 AND coalesce(expiries, 0) < 2")
def batch_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.batch_eligible(records(spark, sf_dir)).select("id")


_OUTREACH = "CASE WHEN id IS NULL THEN 'not_found' WHEN entity_type <> 'attraction' THEN 'not_attraction' WHEN routing <> 'dlq' THEN 'not_in_dlq' WHEN sub_state = 'whatsapp_in_progress' THEN 'already_in_whatsapp' WHEN website IS NOT NULL THEN 'has_horario_or_preco' END"


@query(
    f"""SELECT o_orderkey AS request, {_OUTREACH} AS reason, count({_OUTREACH}) OVER (PARTITION BY o_custkey) = 0 AS moved, CASE WHEN coalesce(phone, '') <> '' THEN 'outreach' ELSE 'discovery' END AS branch
FROM orders LEFT JOIN {R} ON id = o_custkey AND id % 10 <> 7"""
)
def outreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in groups: the first rule that fails, and a group moves as a whole or not at all."""
    from varzea.operators.rules import all_or_nothing

    r = records(spark, sf_dir).filter("id % 10 <> 7").withColumn("found", F.lit(True))
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request"), "o_custkey").join(r, F.col("o_custkey") == F.col("id"), "left")
    d = d.withColumn("in_whatsapp", F.col("sub_state") == "whatsapp_in_progress").withColumn("has_hours", gates.has_hours_or_price(F.array().cast("array<string>"), F.col("website"), F.lit(None)))
    d = d.withColumn("reason", gates.outreach_reason())
    return all_or_nothing(d, "o_custkey", "reason").select("request", "reason", "moved", gates.outreach_branch(F.col("phone")).alias("branch"))


@query(f"SELECT id, CASE WHEN status IN ('CLOSED_PERMANENTLY', 'CLOSED_TEMPORARILY') THEN 'descarte' WHEN NOT {_RECENT} THEN 'dlq' ELSE routing END AS routing, CASE WHEN status IN ('CLOSED_PERMANENTLY', 'CLOSED_TEMPORARILY') THEN 'closed_place' WHEN NOT {_RECENT} THEN 'no_recent_reviews' END AS reason FROM {R}")
def place_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routing, reason = gates.place_route(F.col("status"), F.col("newest_review"), _now(), F.col("routing"))
    return records(spark, sf_dir).select("id", routing.alias("routing"), reason.alias("reason"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN n_name || ' sul' END AS district, n_nationkey % 3 <> 0 AND n_nationkey % 4 <> 0 AS has_fields FROM nation")
def seat_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the districts bear the municipality's name in other case and marks."""
    k = F.col("n_nationkey")
    name = F.when(k % 3 == 0, F.lower(F.translate("n_name", "AE", "ÁÊ"))).otherwise(F.concat(F.col("n_name"), F.lit(" sul")))
    fields = enrich.district_fields(name, F.when(k % 4 != 0, k.cast("string")), F.col("n_name"), F.lit("1"))
    return table(spark, sf_dir, "nation").select(k, gates.seat_district(name, F.col("n_name")).alias("district"), fields.isNotNull().alias("has_fields"))


_LICENSES = ["CC BY-SA 4.0", "cc-by-3.0", "CC0", "", "cc-by-nd-2.0", "CC-BY-NC", "Public domain", "pd-old", "NoDerivs", None]
_LICENSE_SQL = "CASE p_partkey % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN 'ok' WHEN 2 THEN 'ok' WHEN 3 THEN 'unknown' WHEN 4 THEN 'rejected:nd' WHEN 5 THEN 'rejected:nc' WHEN 6 THEN 'ok' WHEN 7 THEN 'ok' WHEN 8 THEN 'rejected:nd' ELSE 'unknown' END"


@query(f"SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'rejected:restrictions' ELSE {_LICENSE_SQL} END AS verdict, p_partkey % 4 IN (0, 3) AND p_size % 3 <> 0 AS photo, p_partkey % 4 = 3 AS restricted FROM part")
def image_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    title = F.concat("p_name", F.when(k % 4 == 0, ".JPG").when(k % 4 == 1, ".SVG").when(k % 4 == 2, " Coat of arms.jpg").otherwise(" Fotos Humanizadas 2018.jpg"))
    license = F.get(F.array(*(F.lit(x) for x in _LICENSES)), (k % 10).cast("int"))
    mime = F.when(F.col("p_size") % 3 != 0, "image/jpeg").when(F.col("p_size") % 2 == 0, "video/ogg")
    return table(spark, sf_dir, "part").select(k, gates.license_verdict(license, F.when(F.col("p_size") % 5 == 0, "personality").otherwise("")).alias("verdict"), gates.is_photo(title, mime).alias("photo"), gates.is_restricted(title).alias("restricted"))


@query(f"SELECT id FROM (SELECT *, {KIND.replace('c_custkey', 'id')} AS type FROM {R}) WHERE type = 'atrativo' AND uf = 'BA' AND lower(name) LIKE '%9%'")
def board_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = records(spark, sf_dir, f"{KIND} AS type").withColumn("title", F.col("name"))
    return gates.filter_cards(d, "atrativo", "BA", " 9 ").select("id")


@query(f"SELECT id FROM {R} WHERE entity_type = 'attraction' AND sub_state = 'awaiting' AND uf = 'SP' ORDER BY id LIMIT 20")
def gate_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature."""
    return gates.gate_queue(records(spark, sf_dir), "SP", 20).select("id")


@query(f"SELECT id, CASE WHEN sub_state = 'awaiting' AND d = 'approve' THEN 'approved' WHEN sub_state = 'awaiting' AND d = 'reject' THEN 'rejected' ELSE sub_state END AS sub_state, d IS NOT NULL AND sub_state IS DISTINCT FROM 'awaiting' AS conflict FROM (SELECT *, CASE id % 4 WHEN 0 THEN 'approve' WHEN 2 THEN 'reject' END AS d FROM {R})")
def gate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id") % 4
    after, conflict = gates.gate_decision(F.col("sub_state"), F.when(k == 0, "approve").when(k == 2, "reject"))
    return records(spark, sf_dir).select("id", after.alias("sub_state"), conflict.alias("conflict"))


@query(f"SELECT id, {SCORE} AS score, CASE WHEN {SCORE} >= 80 THEN 'mar' ELSE 'dlq' END AS routing FROM (SELECT id, origin, completeness, corroboration, recency, 100.0 AS human FROM {R} WHERE routing = 'dlq' AND uf = 'MG' ORDER BY id LIMIT 1000)")
def batch_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region's queue, a thousand at most (the limit is the feature)."""
    return gates.validated(records(spark, sf_dir), "MG").select("id", "score", "routing")


_DROPS = ", ".join(f"('{k}', '{e}')" for k, es in gates.DROPS.items() for e in es)


@query(
    f"""SELECT id, CASE WHEN col <> expected THEN 'conflict' WHEN NOT ok THEN 'refused' WHEN type = 'atrativo' AND target = 'mar' AND NOT {_RECENT} THEN 'held' ELSE 'moved' END AS outcome, CASE WHEN col <> target AND here THEN 'transition' END AS "drop", CASE WHEN type = 'destino' THEN 'reprocess' END AS retry
FROM (SELECT *, (type, expected || '>' || target) IN (SELECT (k, e) FROM (VALUES {_DROPS}) v(k, e)) AS ok, (type, col || '>' || target) IN (SELECT (k, e) FROM (VALUES {_DROPS}) v(k, e)) AS here
FROM (SELECT *, {KIND.replace('c_custkey', 'id')} AS type, CASE id % 3 WHEN 0 THEN 'rio' WHEN 1 THEN 'dlq' ELSE 'mar' END AS col, CASE WHEN id % 7 = 0 THEN 'rio' ELSE CASE id % 3 WHEN 0 THEN 'rio' WHEN 1 THEN 'dlq' ELSE 'mar' END END AS expected, CASE id % 4 WHEN 0 THEN 'mar' WHEN 1 THEN 'dlq' WHEN 2 THEN 'descarte' ELSE 'rio' END AS target FROM {R}))"""
)
def board_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves with the expected column, held promotions, and what the board itself would do."""
    k = F.col("id")
    column = F.when(k % 3 == 0, "rio").when(k % 3 == 1, "dlq").otherwise("mar")
    target = F.when(k % 4 == 0, "mar").when(k % 4 == 1, "dlq").when(k % 4 == 2, "descarte").otherwise("rio")
    d = records(spark, sf_dir, f"{KIND} AS type").withColumns({"column": column, "expected": F.when(k % 7 == 0, "rio").otherwise(column), "target": target})
    c = F.col
    return gates.transition(d, _now()).select("id", "outcome", gates.drop_action(c("type"), c("column"), c("target")).alias("drop"), gates.retry_action(c("type")).alias("retry"))


@query(f"SELECT id, routing = 'mar' AS conflict FROM {R}")
def discard_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = records(spark, sf_dir)
    return gates.discard_guard(d, d.filter("routing = 'mar'")).select("id", "conflict")


@query(
    f"""SELECT id, {SCORE} AS score, routing, lat, newest FROM (SELECT id, origin, corroboration, human, CASE WHEN d THEN greatest(recency, id % 60) ELSE recency END AS recency, CASE WHEN d AND id % 4 = 0 THEN greatest(completeness, 90.0) ELSE completeness END AS completeness,
 CASE WHEN d AND id % 6 = 0 THEN 1.5 ELSE lat END::DOUBLE AS lat, CASE WHEN d THEN greatest(coalesce(newest_review, {NOW} - INTERVAL 40 DAY), {NOW} - INTERVAL 40 DAY) ELSE newest_review END AS newest, d AND status IN ('CLOSED_PERMANENTLY', 'CLOSED_TEMPORARILY') AS closed FROM (SELECT *, id % 2 = 0 AS d FROM {R})), LATERAL (SELECT CASE WHEN closed THEN 'descarte' WHEN {SCORE} >= 80 THEN 'mar' ELSE 'dlq' END AS routing)"""
)
def enrichment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second record has details, some with a position, some with hours."""
    d = records(spark, sf_dir).withColumn("lng", F.col("lon"))
    k = F.col("id")
    details = d.filter("id % 2 = 0").select("id", "status", (_now() - F.make_interval(days=F.lit(40))).alias("newest"), (k % 60).cast("double").alias("recency"), F.when(k % 6 == 0, 1.5).alias("lat"), F.when(k % 6 == 0, 2.5).alias("lng"), (k % 4 == 0).alias("has_hours"))
    return enrich.merge_details(d, details, _now()).select("id", "score", "routing", "lat", F.col("newest_review").alias("newest"))


@query(
    f"""SELECT id, {SCORE.replace('corroboration', '0.0')} AS score, routing, reason, recent FROM (SELECT id, origin, completeness, human, routing AS old, status, a, CASE WHEN a <= 30 THEN 100.0 WHEN a <= 180 THEN 50.0 ELSE 0.0 END AS recency, CASE WHEN a IS NULL THEN 0 ELSE CASE WHEN a <= 30 THEN 1 ELSE 0 END + CASE WHEN a + 20 <= 30 THEN 1 ELSE 0 END END AS recent, score
 FROM (SELECT *, {AGE.replace('c_custkey', 'id')} AS a FROM {R})), LATERAL (SELECT CASE WHEN status LIKE 'CLOSED%' THEN 'descarte' WHEN a IS NULL OR a > 90 THEN 'dlq' WHEN {SCORE.replace('corroboration', '0.0')} >= 80 THEN 'mar' ELSE 'dlq' END AS routing, CASE WHEN status LIKE 'CLOSED%' THEN 'closed_place' WHEN a IS NULL OR a > 90 THEN 'no_recent_reviews' END AS reason)"""
)
def signal_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reviews a record, or none."""
    n = F.col("newest_review")
    d = records(spark, sf_dir).withColumn("reviews", F.when(n.isNotNull(), F.array(n - F.make_interval(days=F.lit(20)), n, F.lit(None).cast("timestamp_ntz"))))
    return enrich.gather_signals(d, _now()).select("id", "score", "routing", "reason", F.col("reviews_recent").alias("recent"))


_LINKS = ["https://www.instagram.com/placeK?hl=pt", "http://instagram.com/@placeK/", "https://notinstagram.com/placeK", "https://siteK.com/instagram.com", "instagram.com/placeK/p/1", "https://instagram.com/", "", None, "https://siteK"]
_PHONES = ["+1 491 555 2671", "+351 912 345 678", "(73) 9 9999-0001", "7333220001", "+55 73 99999-0001", "", None]
_of = lambda texts, x: f"CASE {x} " + " ".join(f"WHEN {i} THEN " + ("NULL" if t is None else f"replace('{t}', 'K', id::VARCHAR)") for i, t in enumerate(texts)) + " END"
_CONTACTS = f"""(SELECT id, l AS website, CASE WHEN list_contains(['instagram.com', 'www.instagram.com'], s[h]) AND q <> '' THEN CASE WHEN q[1] = '@' THEN q ELSE '@' || q END END AS ig_handle, e AS phone_e164, CASE WHEN e[:3] = '+55' AND length(e) = 14 AND e[6] = '9' THEN e[:5] || '*****' || e[-2:] END AS whatsapp_candidate, place_id, sub_state
 FROM (SELECT *, split_part(s[h + 1], '?', 1) AS q, CASE WHEN d[1] = '+' THEN d WHEN length(d) IN (10, 11) THEN '+55' || d END AS e
 FROM (SELECT *, coalesce(nullif(list_position(s, 'instagram.com'), 0), nullif(list_position(s, 'www.instagram.com'), 0)) AS h FROM (SELECT *, nullif({_of(_LINKS, f'id % {len(_LINKS)}')}, '') AS l, string_split(rtrim(l, '/'), '/') AS s, nullif(regexp_replace({_of(_PHONES, f'id % {len(_PHONES)}')}, '[^0-9+]', '', 'g'), '') AS d FROM {R}))))"""


def _gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    pick = lambda texts: F.replace(F.get(F.array(*map(F.lit, texts)), (k % len(texts)).cast("int")), F.lit("K"), k.cast("string"))
    return enrich.gather_contacts(records(spark, sf_dir).withColumn("link", pick(_LINKS)).withColumn("phone", pick(_PHONES)))


@query(f"SELECT id, CASE WHEN p THEN website END AS website, CASE WHEN p THEN ig_handle END AS ig_handle, CASE WHEN p THEN phone_e164 END AS phone_e164, CASE WHEN p THEN whatsapp_candidate END AS whatsapp_candidate, CASE WHEN p THEN 'contacts_found' ELSE sub_state END AS sub_state FROM (SELECT *, place_id IS NOT NULL AS p FROM {_CONTACTS})")
def contact_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to profiles and to other sites, numbers of three countries."""
    return _gathered(spark, sf_dir).drop("before")


@query(f"SELECT 'sub_state_advanced' AS action, 'attraction' AS entity_type, id AS record_id, sub_state AS before_state, 'contacts_found' AS after_state, 'contact_finder_agent' AS actor FROM {R} WHERE place_id IS NOT NULL AND sub_state IS DISTINCT FROM 'contacts_found'")
def contact_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.contact_audit(_gathered(spark, sf_dir))


@query(f"SELECT 'manual:' || uf || ':' || id AS source_ref, {SCORE.replace('origin', '100.0').replace('human', '100.0')} AS score, CASE WHEN {SCORE.replace('origin', '100.0').replace('human', '100.0')} >= 80 THEN 'mar' ELSE 'dlq' END AS routing FROM {R}")
def manual_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.manual_records(records(spark, sf_dir)).select("source_ref", "score", "routing")


@query(f"SELECT id, source_ref, corroboration, reason FROM (SELECT id, 'tripadvisor:' || uf || ':' || id AS source_ref, CASE WHEN n IS NULL OR n <= 0 THEN 0.0 ELSE floor(least(100.0, 100.0 * ln(1 + n::DOUBLE) / ln(501.0)) * 100 + 0.5) / 100 END::DOUBLE AS corroboration, NULL AS reason FROM (SELECT *, attempts * 50 AS n FROM {R}) WHERE municipio_id IS NOT NULL UNION ALL SELECT id, NULL, NULL, 'ibge_unmatched' FROM {R} WHERE municipio_id IS NULL)")
def ingest_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = records(spark, sf_dir).withColumn("reviews", F.col("attempts") * 50)
    resolved = d.filter("municipio_id IS NOT NULL").select("id", F.col("municipio_id").alias("place_code"), F.lit("name").alias("resolved_via"))
    good, bad = enrich.ingest(d, resolved)
    return good.select("id", "source_ref", "corroboration", F.lit(None).cast("string").alias("reason")).unionByName(bad.withColumns({"source_ref": F.lit(None).cast("string"), "corroboration": F.lit(None).cast("double")}))


@query(
    """SELECT destination, place_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY destination ORDER BY position, place_id) AS rank FROM (SELECT l_suppkey AS destination, l_partkey AS place_id, l_linenumber AS position FROM lineitem
 WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_suppkey) = 1)) JOIN (SELECT s_suppkey, s_suppkey % 4 AS target FROM supplier) ON s_suppkey = destination WHERE rank <= target"""
)
def discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as search results: each part once, unknown ones only, up to a supplier's target."""
    results = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("destination"), F.col("l_partkey").alias("place_id"), F.col("l_linenumber").alias("position"))
    targets = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("destination"), (F.col("s_suppkey") % 4).alias("target_count"))
    return enrich.discovered(results, targets, table(spark, sf_dir, "part").filter("p_size < 10").select(F.col("p_partkey").alias("place_id")))


@query(f"SELECT id, CASE WHEN id % 2 = 0 THEN uf ELSE split_part(source_ref, ':', 2) END AS uf, coalesce(ibge_code, split_part(source_ref, ':', 3)) AS code FROM {R}")
def parent_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    uf, code = enrich.parent_fields(F.when(F.col("id") % 2 == 0, F.col("uf")), F.col("ibge_code"), F.col("source_ref"))
    return records(spark, sf_dir).select("id", uf.alias("uf"), code.alias("code"))


@query(
    f"""SELECT id, CASE WHEN id % 3 = 0 THEN 'own' WHEN id % 4 <> 0 THEN 'raw' END AS signals, CASE WHEN id % 4 <> 0 THEN status END AS payload, coalesce(a, '') AS audit FROM {R} LEFT JOIN (SELECT user_id, string_agg(event_type, ',' ORDER BY ts, event_type) AS a FROM events GROUP BY 1) ON user_id = id"""
)
def record_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working row, raw payload and audit trail in one row each."""
    d = records(spark, sf_dir)
    working = d.select("id", F.col("id").alias("raw_id"), F.when(F.col("id") % 3 == 0, "own").alias("signals"))
    raw = d.filter("id % 4 <> 0").select(F.col("id").alias("raw_id"), F.col("status").alias("payload"), F.lit("raw").alias("signals"))
    audit = table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"), F.col("ts").alias("at"), F.col("event_type").alias("action"))
    return enrich.record_detail(working, raw, audit).select("id", "signals", "payload", F.array_join("audit", ",").alias("audit"))


@query(f"SELECT r.id AS id, d.doc_id AS raw_id FROM {R} r JOIN (SELECT doc_id, lang FROM documents) d ON d.doc_id = r.id")
def working_with_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("raw_id"))
    return records(spark, sf_dir).join(raw, F.col("id") == F.col("raw_id")).select("id", "raw_id")


@query("SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_type LIKE '%STEEL%' THEN 0 WHEN p_type LIKE '%BRASS%' THEN 1 ELSE 2 END, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END, CASE WHEN p_size % 5 = 0 THEN 9999 ELSE p_size END, -(p_size * p_partkey), p_partkey) AS INT) AS place FROM part QUALIFY place <= 10")
def image_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best pictures of each place, a brand (the limit is the feature)."""
    size = F.col("p_size")
    d = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.when(F.col("p_type").contains("STEEL"), "featured").when(F.col("p_type").contains("BRASS"), "quality").otherwise("").alias("assessments"), F.when(size % 2 == 0, F.array(F.lit("Wiki Loves Earth"))).otherwise(F.array(F.lit("x"))).alias("categories"), F.when(size % 5 != 0, size).alias("dist"), size.alias("width"), F.col("p_partkey").alias("height"))
    return enrich.best_images(d, "p_brand", 10, "p_partkey").select("p_partkey", "place")


@query(f"SELECT a.id AS id, b.name AS parent_name FROM {R} a LEFT JOIN (SELECT source_ref, min(name) AS name FROM (SELECT parent_source_ref AS source_ref, municipio AS name FROM {R} WHERE entity_type = 'destination' AND parent_source_ref IS NOT NULL) GROUP BY 1) b ON b.source_ref = a.parent_source_ref WHERE a.entity_type = 'attraction' ORDER BY a.newest_review DESC NULLS LAST, a.id LIMIT 15")
def image_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest fifteen attractions with their parent (the limit is the feature)."""
    d = records(spark, sf_dir).withColumn("published", F.col("newest_review"))
    parents = d.filter("entity_type = 'destination' AND parent_source_ref IS NOT NULL").groupBy(F.col("parent_source_ref").alias("source_ref")).agg(F.min("municipio").alias("name"))
    return enrich.cohort(d, parents, 15).select("id", "parent_name")


@query()
def photo_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photographs of places by name and region (Indel ratios: tested against every pair)."""
    photos = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("photo"), F.col("p_size").alias("area"), F.array(F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, " (Bahia)").otherwise(""))).alias("categories"), F.concat("p_brand", F.when(F.col("p_partkey") % 3 == 1, " - SP").otherwise("")).alias("object_name"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("bahia").alias("municipality"), F.when(F.col("p_partkey") % 2 == 0, "BA").otherwise("SP").alias("uf"))
    return enrich.photo_matches(rows, photos)


@query("SELECT n_nationkey, trim(n_name) || ', Rua' AS dashed, n_name || ' e ' || n_name AS bare, CASE n_nationkey % 3 WHEN 0 THEN 'MG' WHEN 1 THEN 'SP' END AS uf FROM nation")
def dashes_and_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    categories = F.when(k % 3 == 0, F.array(F.lit("no state"), F.lit("Gruta (Minas Gerais)")))
    title = F.when(k % 3 == 1, "2022-SP_foto").when(k % 3 == 2, "de SP a RJ").otherwise("x RJ")
    return table(spark, sf_dir, "nation").select(k, scalars.strip_dashes(F.concat(F.col("n_name"), F.lit(" — Rua"))).alias("dashed"), scalars.strip_dashes(F.concat(F.lit("–"), F.col("n_name"), F.lit("—e  "), F.col("n_name"), F.lit(" "))).alias("bare"), scalars.uf_hint(categories, title).alias("uf"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts WHEN event_id % 3 = 1 THEN ts - INTERVAL 3 HOUR END AS moment, CASE WHEN event_id % 3 < 2 THEN date_trunc('day', ts) END AS day FROM events")
def iso_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC where no zone is named, an offset, and a text that is no time."""
    k, t = F.col("event_id") % 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    d = table(spark, sf_dir, "events").select("event_id", F.when(k == 0, t).when(k == 1, F.concat(t, F.lit("+03:00"))).otherwise("soon").alias("x"), F.when(k < 2, F.date_format("ts", "yyyy-MM-dd")).otherwise("").alias("d"))
    return d.select("event_id", scalars.moment(F.col("x")).cast("timestamp_ntz").alias("moment"), scalars.moment(F.col("d")).cast("timestamp_ntz").alias("day"))


@query("SELECT c_custkey, map_keys(m) AS keys, length(map_extract(m, 'note')[1])::INTEGER AS size FROM (SELECT c_custkey, MAP {'name': c_name, 'note': repeat('x', 2000)} AS m FROM customer)")
def log_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(F.lit("name"), F.col("c_name"), F.lit("Cookie"), F.lit("c"), F.lit("TOKEN"), F.lit("t"), F.lit("note"), F.expr("repeat('x', 2500)"))
    d = table(spark, sf_dir, "customer").select("c_custkey", scalars.sanitize(fields).alias("m"))
    return d.select("c_custkey", F.map_keys("m").alias("keys"), F.length(F.try_element_at("m", F.lit("note"))).alias("size"))
