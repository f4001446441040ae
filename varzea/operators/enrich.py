"""Ingest and enrichment: places resolved, signals merged, discovery bounded, photographs matched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions import scalars
from varzea.operators.gates import CLOSED, place_route, seat_district
from varzea.operators.matching import partly_similar, similar, similar_among
from varzea.shared import checkpointed


def review_summary(reviews: Column, now: Column) -> Column:
    """struct(newest, recent, atualidade) of an array of moments: newest, how many of the last 30 days, and the recency value."""
    times = F.filter(F.coalesce(reviews, F.array().cast("array<timestamp_ntz>")), lambda t: t.isNotNull())
    newest = F.array_max(times)
    since = lambda days: now - F.make_interval(days=F.lit(days))
    value = F.when(newest >= since(30), 100.0).when(newest >= since(180), 50.0).otherwise(0.0)
    return F.struct(newest.alias("newest"), F.size(F.filter(times, lambda t: t >= since(30))).alias("recent"), value.alias("atualidade"))


def rescored(rows: DataFrame) -> DataFrame:
    score, _ = scalars.reliability()
    return rows.withColumn("score", score)


def merge_details(rows: DataFrame, details: DataFrame, now: Column, row_id: str = "id") -> DataFrame:
    """Records after a place's details: the higher recency and the later review of both, the place's position over the
    record's, completeness 90 at least where hours are known, closed places discarded; scored and routed anew."""
    d = rows.join(details.select(F.col(row_id), *(F.col(c).alias(f"d_{c}") for c in ("status", "newest", "recency", "lat", "lng", "has_hours"))), row_id, "left")
    d = d.withColumn("recency", F.greatest("recency", F.coalesce("d_recency", "recency"))).withColumn("newest_review", F.coalesce(F.greatest("newest_review", "d_newest"), "newest_review", "d_newest"))
    d = d.withColumn("lat", F.coalesce("d_lat", "lat")).withColumn("lng", F.coalesce("d_lng", "lng"))
    d = rescored(d.withColumn("completeness", F.when(F.col("d_has_hours"), F.greatest("completeness", F.lit(90.0))).otherwise(F.col("completeness"))))
    closed = F.coalesce(F.col("d_status").isin(CLOSED), F.lit(False))
    return d.withColumn("routing", F.when(closed, "descarte").otherwise(scalars.route(F.col("score")))).drop(*(f"d_{c}" for c in ("status", "newest", "recency", "lat", "lng", "has_hours")))


def gather_signals(rows: DataFrame, now: Column) -> DataFrame:
    """Recency from a place's reviews, corroboration back to 0, scored anew; closed and stale places by their own routes."""
    d = rows.withColumn("_s", review_summary(F.col("reviews"), now)).withColumn("recency", F.col("_s.atualidade")).withColumn("corroboration", F.lit(0.0))
    routing, reason = place_route(F.col("status"), F.col("_s.newest"), now, scalars.route(F.col("score")))
    return rescored(d).withColumn("routing", routing).withColumn("reason", reason).withColumn("reviews_recent", F.col("_s.recent")).drop("_s")


def gather_contacts(rows: DataFrame) -> DataFrame:
    """(id, website, ig_handle, phone_e164, whatsapp_candidate, sub_state, before): a place's contacts from its details (link and
    phone). The candidate is masked, and null for a landline. Records without a place stay as they are."""
    known = F.col("place_id").isNotNull()
    only = lambda x: F.when(known, x)
    phone = scalars.phone_e164(F.col("phone"))
    return rows.select(
        "id", only(F.nullif(F.col("link"), F.lit(""))).alias("website"), only(scalars.instagram_handle(F.col("link"))).alias("ig_handle"), only(phone).alias("phone_e164"),
        only(scalars.whatsapp_candidate(phone)).alias("whatsapp_candidate"), F.when(known, "contacts_found").otherwise(F.col("sub_state")).alias("sub_state"), F.col("sub_state").alias("before"),
    )


def contact_audit(gathered: DataFrame) -> DataFrame:
    """An audit row for each record that gather_contacts has moved on."""
    moved = gathered.filter((F.col("sub_state") == "contacts_found") & ~F.coalesce(F.col("before") == "contacts_found", F.lit(False)))
    return moved.select(F.lit("sub_state_advanced").alias("action"), F.lit("attraction").alias("entity_type"), F.col("id").alias("record_id"), F.col("before").alias("before_state"), F.col("sub_state").alias("after_state"), F.lit("contact_finder_agent").alias("actor"))


def manual_records(rows: DataFrame) -> DataFrame:
    """Records that a person enters: source manual, origin and human criteria at 100, scored and routed."""
    d = rows.withColumn("source_ref", F.concat(F.lit("manual:"), F.col("uf"), F.lit(":"), F.col("id").cast("string"))).withColumn("origin", F.lit(100.0)).withColumn("human", F.lit(100.0))
    return rescored(d).withColumn("routing", scalars.route(F.col("score")))


def ingest(rows: DataFrame, resolved: DataFrame, row_id: str = "id", source: str = "tripadvisor") -> tuple[DataFrame, DataFrame]:
    """(raw, quarantined): rows whose municipality is resolved get their reference and score inputs, others go aside as ibge_unmatched."""
    d = rows.join(resolved.select(row_id, "place_code", "resolved_via"), row_id, "left")
    good = d.filter(F.col("place_code").isNotNull()).withColumn("source_ref", F.concat_ws(":", F.lit(source), F.col("uf"), F.col(row_id).cast("string")))
    good = good.withColumn("corroboration", scalars.corroboration_from_reviews(F.col("reviews"))).withColumn("origin", F.lit(65.0))
    return good, d.filter(F.col("place_code").isNull()).select(row_id, F.lit("ibge_unmatched").alias("reason"))


def discovered(results: DataFrame, targets: DataFrame, seen: DataFrame) -> DataFrame:
    """Of several queries' results each place once (at its best position), none that is known, and per destination as many as
    it still wants (its target is the feature)."""
    w = W.partitionBy("place_id").orderBy("position", "destination")
    once = results.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n").join(seen.select("place_id").distinct(), "place_id", "left_anti")
    order = W.partitionBy("destination").orderBy("position", "place_id")
    return once.join(targets, "destination").withColumn("rank", F.row_number().over(order)).filter("rank <= target_count").select("destination", "place_id", "rank")


def district_fields(district: Column, code: Column, municipality: Column, ibge: Column) -> Column:
    """struct of a district hint's fields, null where nothing matched or the district is the seat."""
    name = seat_district(district, municipality)
    return F.when(name.isNotNull() & code.isNotNull(), F.struct(name.alias("distrito_name"), code.alias("distrito_code"), ibge.alias("distrito_municipio_ibge")))


def parent_fields(uf: Column, ibge: Column, ref: Column) -> tuple[Column, Column]:
    """Region and code of a parent, from its own fields or from its reference source:UF:code."""
    part = lambda n: F.nullif(F.split_part(ref, F.lit(":"), F.lit(n)), F.lit(""))
    return F.coalesce(uf, part(2)), F.coalesce(ibge, part(3))


def record_detail(working: DataFrame, raw: DataFrame, audit: DataFrame) -> DataFrame:
    """A record with its raw payload, its signals (of the working row, else of the payload) and its audit trail in order of time."""
    trail = audit.groupBy(F.col("record_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("at", "action"))).alias("_trail"))
    d = working.join(raw.select("raw_id", "payload", F.col("signals").alias("_raw_signals")), "raw_id", "left").join(trail, "id", "left")
    return d.withColumn("signals", F.coalesce("signals", "_raw_signals")).withColumn("audit", F.coalesce(F.transform("_trail", lambda x: x["action"]), F.array().cast("array<string>"))).drop("_raw_signals", "_trail")


def photo_matches(rows: DataFrame, photos: DataFrame, top: int = 3) -> DataFrame:
    """(id, photo, confidence, via): up to `top` photographs of a place by name, or by a weaker name with the municipality.

    A photograph that names a region meets records of that region only, others meet all; both meet records without a region.
    Distinct names and photographs' texts are compared by key (a region, none, or an unknown one), and only those that share
    letter pairs enough: names at 88, and at 72 beside municipalities at 88."""
    states = F.array(*(F.lit(u) for u in sorted(set(scalars.STATES.values()))))
    r = rows.select("id", scalars.squeeze_alnum(F.col("name")).alias("_name"), scalars.squeeze_alnum(F.coalesce("municipality", F.lit(""))).alias("_muni"), F.when(F.col("uf").isNull(), "*").when(F.array_contains(states, F.col("uf")), F.col("uf")).otherwise("-").alias("_key"))
    p = photos.select("photo", "area", scalars.squeeze_alnum(F.concat_ws(" ", F.array_join("categories", " "), "object_name")).alias("_hay"), scalars.uf_hint(F.col("categories"), F.col("object_name")).alias("_uf"))
    keys = F.when(F.col("_uf").isNotNull(), F.array("_uf", F.lit("*"))).otherwise(F.concat(states, F.array(F.lit("*"), F.lit("-"))))
    p = p.withColumn("_key", F.explode(keys)).drop("_uf").join(F.broadcast(r.select("_key").distinct()), "_key", "left_semi")  # the regions and two more at most
    texts = lambda d, c: d.select(F.struct(F.col("_key").alias("key"), F.col(c).alias("text")).alias("id")).distinct().select("id", F.col("id.key").alias("block"), F.col("id.text").alias("name"))
    names, munis, hays = (checkpointed(x) for x in (texts(r, "_name"), texts(r.filter("_muni <> ''"), "_muni"), texts(p, "_hay")))  # the joins read them several times
    near = partly_similar(munis, hays, 88.0).select(F.col("l.key").alias("_key"), F.col("l.text").alias("_muni"), F.col("r.text").alias("_hay"), F.col("ratio").alias("_m"))
    both = r.select("_key", "_name", "_muni").distinct().join(near, ["_key", "_muni"])
    pairs = both.select(F.struct(F.col("_key").alias("key"), F.col("_name").alias("text")).alias("l"), F.struct(F.col("_key").alias("key"), F.col("_hay").alias("text")).alias("r")).distinct()
    split = lambda d: d.select(F.col("l.key").alias("_key"), F.col("l.text").alias("_name"), F.col("r.text").alias("_hay"), F.col("ratio").alias("_n"))
    strong = split(similar(names, hays, 88.0, "set")).join(r.select("_key", "_name", "_muni").distinct(), ["_key", "_name"]).select("_key", "_name", "_muni", "_hay", F.col("_n").alias("confidence"), F.lit("nome").alias("via"))
    weak = split(similar_among(pairs, names, hays, 72.0)).filter("_n < 88").join(both, ["_key", "_name", "_hay"])
    weak = weak.select("_key", "_name", "_muni", "_hay", F.round(0.7 * F.col("_n") + 0.3 * F.col("_m")).alias("confidence"), F.lit("nome+municipio").alias("via"))
    order = [F.desc("area"), "photo"]
    best = lambda d, by, order: d.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    first = best(p, ["_key", "_hay"], order).drop("rank")  # of photographs with the same text, and records with the same texts, no more can be among the best
    s = best(strong.unionByName(weak).join(first, ["_key", "_hay"]), ["_key", "_name", "_muni"], [F.desc("confidence"), *order]).drop("rank", "_hay")
    return best(s.join(r, ["_key", "_name", "_muni"]), ["id"], [F.desc("confidence"), *order]).select("id", "photo", "confidence", "via", "rank")


def image_order() -> list[Column]:
    """Lower is better: featured, then quality pictures, those of a contest, the nearer (unknown is far), the larger."""
    curated = F.when(F.col("assessments").contains("featured"), 0).when(F.col("assessments").contains("quality"), 1).otherwise(2)
    contest = F.when(F.exists("categories", lambda c: c.contains("Wiki Loves")), 0).otherwise(1)
    distance = F.coalesce(F.nullif(F.col("dist"), F.lit(0)), F.lit(9999))
    return [curated, contest, distance, -(F.col("width") * F.col("height"))]


def best_images(images: DataFrame, place: str, limit: int, tie: str) -> DataFrame:
    """The `limit` best images of each place, with their place in the order."""
    w = W.partitionBy(place).orderBy(*image_order(), tie)
    return images.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= limit)


def cohort(rows: DataFrame, parents: DataFrame, limit: int) -> DataFrame:
    """Published attractions with their parent's name in one join, the newest `limit` (which is the feature)."""
    p = parents.select(F.col("source_ref").alias("parent_source_ref"), F.col("name").alias("parent_name"))
    return rows.filter("entity_type = 'attraction'").join(p, "parent_source_ref", "left").orderBy(F.desc("published"), "id").limit(limit)


