"""What people and agents do to records: bulk ingest, manual entry, edits, owners' answers, requests to writers, configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions import scalars
from varzea.operators import layers, resolve
from varzea.operators.enrich import rescored
from varzea.operators.lifecycle import owner_outcome
from varzea.operators.records import CRITERIA, prompt_context

#: seats farther away than this do not place an attraction of the national bulk
NATIONAL_KM = 50.0


def ingest_attractions(cards: DataFrame, seats: DataFrame, parents: DataFrame | None = None, max_km: float = NATIONAL_KM) -> tuple[DataFrame, DataFrame]:
    """(raw, quarantined) of cards (id, name, category, reviews, rating, lat, lng, uf), each at its nearest municipal seat.

    With `parents` (source_ref of destinations) the card's region is given: the seat is of that region, and a card whose
    destination is not there goes aside as parent_destino_absent. Without, the bulk is national: the seat may be anywhere and
    gives the region, and there is no parent. A card without a position or a seat within `max_km` goes aside as ibge_unmatched."""
    place = resolve.nearest_place(cards.filter("lat IS NOT NULL AND lng IS NOT NULL"), seats, "id", max_km, None if parents is None else "uf")
    regions = seats.select(F.col("place_code").alias("_code"), F.col("place_region").alias("_region"))
    d = cards.join(place.select("id", F.col("place_code").alias("_code")), "id", "left").join(regions, "_code", "left")
    reason = F.when(F.col("_code").isNull(), "ibge_unmatched")
    if parents is not None:
        d = d.withColumn("_parent", F.concat(F.lit("ibge:"), F.col("_region"), F.lit(":"), F.col("_code").cast("string")))
        d = d.join(parents.select(F.col("source_ref").alias("_parent"), F.lit(True).alias("_there")).distinct(), "_parent", "left")
        reason = reason.when(F.col("_there").isNull(), "parent_destino_absent")
    else:
        d = d.withColumn("_parent", F.lit(None).cast("string"))
    d = d.withColumn("reason", reason)
    good = d.filter("reason IS NULL").select(
        F.concat(F.lit("tripadvisor:attraction:"), F.col("id").cast("string")).alias("source_ref"), "id", "name", "category", F.col("_region").alias("uf"), F.col("_code").alias("municipio_id"),
        F.col("_parent").alias("parent_source_ref"), scalars.corroboration_from_reviews(F.col("reviews")).alias("corroboration"), "lat", "lng",
    )
    return good, d.filter("reason IS NOT NULL").select("id", "reason")


def finalized(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Records after their owners' conversations (id, opted_out, exists, works, hours, price): opt-outs and no answers go to review
    with the reason; a confirmed record gets the human criterion 100 and what the owner said, and is scored and routed anew.
    Records without a conversation stay as they are."""
    d = rows.join(answers.select("id", F.lit(True).alias("_heard"), owner_outcome(F.col("opted_out"), F.col("exists"), F.col("works")).alias("_outcome"), "hours", "price"), "id", "left")
    confirmed, refused = F.col("_outcome") == "confirmed", F.col("_heard") & (F.col("_outcome") != "confirmed")
    new = rescored(d.withColumn("_old", F.col("score")).withColumn("human", F.when(confirmed, 100.0).otherwise(F.col("human"))))
    routing = F.when(refused, "dlq").when(confirmed, scalars.route(F.col("score"))).otherwise(F.col("routing"))
    said = lambda c: F.when(confirmed, F.nullif(F.col(c), F.lit("")))
    return new.select(
        *[c for c in rows.columns if c not in ("score", "routing", "human")], "human", F.when(confirmed, F.col("score")).otherwise(F.col("_old")).alias("score"), routing.alias("routing"),
        F.when(refused, F.col("_outcome")).alias("dlq_reason"), said("hours").alias("owner_hours"), said("price").alias("owner_price"),
    )


def manual_versions(entries: DataFrame) -> DataFrame:
    """All versions of manual records (source_ref, id, ingested_at, payload struct): a save under a known reference is a new version
    unless its payload is one that the record has had. `layers.active` of it is what a reader gets."""
    rows = entries.withColumn("source", F.lit("manual")).withColumn("payload", F.to_json("payload", {"ignoreNullFields": "false"}))
    return layers.append_raw(layers.with_content_hash(rows))


def edited(rows: DataFrame, edits: DataFrame, fields: str = "normalized") -> DataFrame:
    """Records with a steward's fields put over their own, key by key; attractions do not take phone_e164 from an edit."""
    new = F.map_filter("_new", lambda k, v: ~((k == "phone_e164") & (F.col("entity_type") == "attraction")))
    kept = lambda m: F.map_filter(F.col(fields), lambda k, v: ~F.map_contains_key(m, k))
    d = rows.join(edits.select("id", F.col("fields").alias("_new")), "id", "left")
    return d.withColumn(fields, F.when(F.col("_new").isNull(), F.col(fields)).otherwise(F.map_concat(kept(new), new))).drop("_new")


def batch_request(rows: DataFrame, model: str, system: str, max_tokens: int = 2048) -> DataFrame:
    """(id, line): a request line for each record, keyed by its id; an id that is no custom id (64 letters, digits, _ and -) has none."""
    text = prompt_context(F.coalesce("name", F.lit("")), F.coalesce("municipio", F.lit("")), F.coalesce("uf", F.lit("")), F.array().cast("array<string>"), F.col("address"), F.array().cast("array<string>"))
    message = F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))
    params = F.struct(F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), F.lit(system).alias("system"), message.alias("messages"))
    key = F.col("id").cast("string")
    return rows.select("id", F.when(key.rlike("^[a-zA-Z0-9_-]{1,64}$"), F.to_json(F.struct(key.alias("custom_id"), params.alias("params")))).alias("line"))


def config_update(current: DataFrame, updates: DataFrame, numbers: dict[str, tuple[float, float]], groups: dict[str, list[str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(overrides, audit, refused) of (scope, key, value) tables. A scope's update counts as a whole or not at all: each key must be
    known and its value a number in its range, and where it touches a group of weights the group's effective sum must be 100.
    Audit rows hold the value before and after of each key that changes hands."""
    known = F.create_map(*(x for k, (a, b) in numbers.items() for x in (F.lit(k), F.array(F.lit(float(a)), F.lit(float(b))))))
    number, bounds = F.col("value").try_cast("double"), F.try_element_at(known, F.col("key"))
    bad = updates.withColumn("_reason", F.when(bounds.isNull(), "unknown_key").when(number.isNull() | ~number.between(bounds[0], bounds[1]), "not_in_range"))
    effective = current.join(updates.select("scope", "key", F.col("value").alias("_new")), ["scope", "key"], "full_outer").withColumn("_value", F.coalesce("_new", "value").try_cast("double"))
    of = F.coalesce(*(F.when(F.col("key").isin(keys), F.lit(g)) for g, keys in groups.items()))
    sums = effective.withColumn("_group", of).filter("_group IS NOT NULL").groupBy("scope", "_group").agg((F.abs(F.sum("_value") - 100) > 0.01).alias("_off"), F.bool_or(F.col("_new").isNotNull()).alias("_touched"))
    off = sums.groupBy("scope").agg(F.bool_or(F.col("_off") & F.col("_touched")).alias("_off"))
    verdict = bad.groupBy("scope").agg(F.min("_reason").alias("_bad")).join(off, "scope", "left").withColumn("reason", F.coalesce("_bad", F.when(F.col("_off"), "weights_sum")))
    good = updates.join(verdict.filter("reason IS NULL").select("scope"), "scope", "left_semi")
    audit = good.join(current.select("scope", "key", F.col("value").alias("before")), ["scope", "key"], "left").select(F.lit("config_updated").alias("action"), "scope", "key", "before", F.col("value").alias("after"), F.lit("steward").alias("actor"))
    overrides = current.join(good.select("scope", "key"), ["scope", "key"], "left_anti").unionByName(good.select(*current.columns))
    return overrides, audit, verdict.filter("reason IS NOT NULL").select("scope", "reason")


def recent_runs(runs: DataFrame, now: Column, hours: int = 24 * 7) -> DataFrame:
    """Runs that started within the last hours; one whose start cannot be read is none of them."""
    return runs.filter(F.coalesce(scalars.moment(F.col("started_at")) >= now - F.make_dt_interval(hours=F.lit(hours)), F.lit(False)))


def run_metrics(runs: DataFrame) -> DataFrame:
    """One row: runs, rows synced and failed, and the percentage of synced ones, 0 without any."""
    n, synced, failed = F.count("*"), F.coalesce(F.sum("synced"), F.lit(0)), F.coalesce(F.sum("failed"), F.lit(0))
    return runs.agg(n.alias("runs"), synced.alias("synced"), failed.alias("failed"), F.coalesce(F.floor(F.try_divide(synced * 100.0, synced + failed) + 0.5), F.lit(0)).alias("pct"))


def image_report(records: DataFrame, images: DataFrame, enough: int = 3) -> DataFrame:
    """(part, cohort, item, n, share) of records (id, cohort) and their images (id, tier, source, license, url): records hit by tier,
    coverage, combinations of sources, images by source and licence, pictures of several records. Images are grouped once, by
    grouping sets; records once, by their number of images and their sources, which are few."""
    d = images.join(records, "id")
    g = d.groupingSets([["cohort", "tier"], ["source", "license"], ["url"]], "cohort", "tier", "source", "license", "url").agg(F.grouping_id().alias("_set"), F.count_distinct("id").alias("_records"), F.count("*").alias("_images"))
    tier, licence, url = (F.col("_set") == int(bits, 2) for bits in ("00111", "11001", "11110"))
    size = records.groupBy("cohort").agg(F.count("*").alias("_all"))
    share = lambda n: F.floor(F.col(n) * 10_000 / F.col("_all") + 0.5) / 10_000
    tiers = g.filter(tier).join(size, "cohort").select(F.lit("tier").alias("part"), "cohort", F.col("tier").alias("item"), F.col("_records").alias("n"), share("_records").alias("share"))
    rest = g.filter(licence | (url & (F.col("_records") > 1))).select(F.when(licence, "license").otherwise("reused").alias("part"), F.lit(None).cast("string").alias("cohort"), F.when(licence, F.concat("source", F.lit(": "), F.coalesce("license", F.lit("-")))).otherwise(F.col("url")).alias("item"), F.when(licence, F.col("_images")).otherwise(F.col("_records")).alias("n"), F.lit(None).cast("double").alias("share"))
    per = records.join(images.groupBy("id").agg(F.count("*").alias("_n"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("_sources")), "id", "left").select("cohort", F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_sources", F.lit("none")).alias("_sources"))
    items = F.concat(F.array(F.struct(F.lit("sources").alias("part"), F.col("_sources").alias("item"))), F.filter(F.array(F.when(F.col("_n") >= enough, F.struct(F.lit("coverage").alias("part"), F.lit("enough").alias("item"))), F.struct(F.lit("coverage").alias("part"), F.when(F.col("_n") > 0, "any").otherwise("none").alias("item"))), lambda x: x.isNotNull()))
    counted = per.select("cohort", F.explode(items).alias("x")).groupBy("cohort", "x.part", "x.item").agg(F.count("*").alias("n")).join(size, "cohort").select("part", "cohort", "item", "n", share("n").alias("share"))
    return tiers.unionByName(rest).unionByName(counted)


def by_cost(costs: DataFrame, key: str) -> DataFrame:
    """Costs, the dearest first, and their place; equal ones by key."""
    return costs.withColumn("place", F.row_number().over(W.partitionBy().orderBy(F.desc("usd"), key))).orderBy("place")


def usage_rows(calls: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Usage rows to append, with their cost: one for each call id that the log does not have."""
    usd = scalars.llm_cost(*(F.col(c) for c in ("tokens_in", "tokens_out", "cache_write", "cache_read", "searches", "batch")))
    return layers.append_once(calls, known, ["call_id"], ["at"]).withColumn("usd", usd)


def search_results(results: DataFrame, limit: int = 20) -> DataFrame:
    """Landed answers of a text search, the first `limit` of each query in their order (the limit is the service's), with the
    address's municipality and region (the last components of their kinds) and district (the first)."""
    of = lambda kind: F.filter("components", lambda c: F.array_contains(c["types"], kind))
    last = lambda kind, text: F.try_element_at(of(kind), F.lit(-1))[text]
    read = [last("administrative_area_level_2", "long_text").alias("municipality"), last("administrative_area_level_1", "short_text").alias("uf"), F.coalesce(F.get(of("administrative_area_level_3"), F.lit(0))["long_text"], F.lit("")).alias("district")]
    w = W.partitionBy("query").orderBy("position")
    d = results.select("query", "position", "place_id", *read)  # read first: what is sorted are three short texts, not the components
    return d.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= limit).drop("_n")


def reprocessed(rows: DataFrame, config: scalars.ScoreConfig) -> DataFrame:
    """Records scored and routed anew under a configuration; below its threshold the reason says by how much. Run twice it changes nothing."""
    score, breakdown = scalars.reliability(config)
    d = rows.drop("score", "routing", "score_version", "dlq_reason").withColumn("score", score).withColumn("score_breakdown", breakdown)
    d = d.withColumn("routing", scalars.route(F.col("score"), config)).withColumn("score_version", F.lit(config.version))
    return d.withColumn("dlq_reason", F.when(F.col("routing") == "dlq", F.format_string(f"score=%.2f below threshold_mar={config.threshold}", "score")))


def score_input(payload: Column) -> Column:
    """The five criteria of a raw payload (map of texts) as numbers, 0 where one is missing or no number."""
    return F.struct(*(F.coalesce(F.try_element_at(payload, F.lit(k)).try_cast("double"), F.lit(0.0)).alias(k) for k in CRITERIA))


# Outcomes of a stage, and the fields of an event's data that may be kept.
STATUSES = ["ok", "fail", "skip"]
DATA = ["score", "routing", "dlq_reason", "reason", "name", "uf", "locationId"]


def record_events(stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events to append, refused) of (source, source_ref, stage, status, message, data map): a row for each, data without fields that
    are no engineering data; rows of an unknown status or without a reference are refused."""
    sound = F.coalesce(F.col("status").isin(STATUSES) & (F.col("source_ref") != ""), F.lit(False))
    kept = stages.withColumn("data", F.map_filter("data", lambda k, v: k.isin(DATA)))
    return kept.filter(sound), stages.filter(~sound)
