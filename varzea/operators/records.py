"""Projections of records: working rows, canonical rows, listings, masked views, payloads for the platform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.functions import hours, scalars

# The five criteria, and the keys that stay out of the canonical layer beside them.
CRITERIA = ["origem_value", "completude_value", "corroboracao_value", "atualidade_value", "validacao_humana_value"]
INTERNAL = ["most_recent_review_at", "contact", "google_enriched", "descricao_attempts"]
# Source field and canonical field of two sources; a dash means that the field is not used.
MAPS = {
    "tripadvisor": [("name", "name"), ("addressObj.city", "municipality"), ("addressObj.state", "uf"), ("category", "type"), ("latitude", "lat"), ("longitude", "lng"), ("numReviews", "review_count"), ("rating", "rating"), ("locationId", "—")],
    "google_places": [("displayName.text", "name"), ("addressComponents.city", "municipality"), ("addressComponents.uf", "uf"), ("primaryType", "type"), ("location.latitude", "lat"), ("location.longitude", "lng"), ("userRatingCount", "review_count"), ("rating", "rating"), ("id", "—")],
}
CANONICAL_ORDER = ["name", "municipality", "uf", "type", "lat", "lng", "review_count", "rating"]


def filled(x: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(x, F.lit(""))


def first_filled(*xs: Column) -> Column:
    return F.coalesce(*map(filled, xs))


def working(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """A raw payload (map of texts) as a working row: normalised name, address and coordinates, criteria that default to 0,
    optional keys only if they are filled, keys of attractions only for attractions, and the taxonomy label."""
    get = lambda k: F.try_element_at(F.col(payload), F.lit(k))
    number = lambda k: get(k).try_cast("double")
    attraction = F.col("entity_type") == "attraction"
    return raw.select(
        *[c for c in raw.columns if c != payload],
        scalars.normalize_name(get("name")).alias("name"),
        scalars.normalize_address(get("address")).alias("address"),
        scalars.coordinate(number("lat")).alias("lat"),
        scalars.coordinate(F.coalesce(number("lon"), number("lng"))).alias("lon"),
        *(F.coalesce(number(k), F.lit(0.0)).alias(k) for k in CRITERIA),
        filled(get("municipio")).alias("municipio"),
        first_filled(get("municipio_id"), get("ibge_code")).alias("municipio_id"),
        filled(get("descricao_editorial")).alias("descricao_editorial"),
        *(F.when(attraction, filled(get(k))).alias(k) for k in ("tipo", "most_recent_review_at", "place_id_cache", "parent_source_ref")),
        F.struct(F.col("entity_type").alias("entity_type"), F.lit("v1.0").alias("taxonomy_version")).alias("labels"),
    )


def canonical_map(normalized: Column, without: list[str] | None = None) -> Column:
    """The map of a working row less the criteria and the internal keys."""
    out = CRITERIA + INTERNAL if without is None else without
    return F.map_filter(normalized, lambda k, v: ~k.isin(out))


def provenance(breakdown: str, version: str, raw_id: str, working_id: str) -> Column:
    return F.struct(F.col(breakdown).alias("score_breakdown"), F.coalesce(version, F.lit("v1.0")).alias("score_version"), F.col(raw_id).alias("nascente_id"), F.col(working_id).alias("rio_id"))


def destination_listing(rows: DataFrame) -> DataFrame:
    return rows.filter("entity_type = 'destination'").select(
        "id", F.coalesce("name", F.lit("")).alias("nome"), "uf", scalars.source_of_key(F.col("source_ref")).alias("fonte"), F.coalesce("score", F.lit(0.0)).alias("score"), "routing", F.coalesce("municipio_id", F.split_part("source_ref", F.lit(":"), F.lit(3))).alias("ibge")
    )


def attraction_listing(rows: DataFrame) -> DataFrame:
    return rows.filter("entity_type = 'attraction'").select(
        "id", F.coalesce("name", F.lit("")).alias("nome"), "uf", F.coalesce("tipo", F.lit("outros")).alias("tipo"), F.coalesce("sub_state", F.lit("none")).alias("sub_state"), F.coalesce("score", F.lit(0.0)).alias("score"), "parent_source_ref"
    )


def safe_contacts(website: Column, phone: Column) -> Column:
    """Of an owner's contacts the website and the masked phone; null if there is neither. Mail and handles are dropped."""
    return F.when(website.isNotNull() | phone.isNotNull(), F.struct(website.alias("website"), F.when(phone.isNotNull(), scalars.mask_phone(phone)).alias("phone_masked")))


def first_phone(*candidates: Column) -> Column:
    """The first filled of several phones, masked."""
    return scalars.mask_phone(first_filled(*candidates))


def mapped(rows: DataFrame, source: str, row_id: str, fields: str = "fields", maps=MAPS) -> DataFrame:
    """(id, source, canonical...) of a map of source fields: the first field that is mapped to a canonical key wins."""
    first: dict[str, str] = {}
    for field, key in maps[source]:
        if key != "—":
            first.setdefault(key, field)
    picked = [F.try_element_at(F.col(fields), F.lit(first[k])).alias(k) if k in first else F.lit(None).cast("string").alias(k) for k in CANONICAL_ORDER]
    return rows.select(row_id, *picked, F.lit(source).alias("source"))


def domain_view(rows: DataFrame) -> DataFrame:
    """The enriched view of a record: its label and whether it has a place, a position and hours."""
    return rows.select("id", "entity_type", F.col("place_id").isNotNull().alias("has_place"), (F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("has_position"), F.coalesce(F.size("weekday_text") > 0, F.lit(False)).alias("has_hours"))


def images(commons: DataFrame, mtur: DataFrame, pixabay: DataFrame) -> DataFrame:
    """Three sources' image records in one shape; fields that a source lacks are null."""
    by = lambda *parts: F.concat(*(F.coalesce(p, F.lit("None")) if isinstance(p, Column) else F.lit(p) for p in parts))
    c = commons.select(F.lit("commons").alias("source"), "url", F.col("descriptionurl").alias("page_url"), "width", "height", F.col("artist").alias("author"), F.col("licenseshortname").alias("license"), by("Foto: ", F.col("artist"), " / ", F.col("licenseshortname")).alias("attribution"), F.col("dist").alias("dist_m"))
    m = mtur.select(F.lit("mtur").alias("source"), "url", "page_url", "width", "height", "author", "license", by("Foto: ", F.col("author")).alias("attribution"), "match_confidence")
    p = pixabay.select(F.lit("pixabay").alias("source"), F.col("largeImageURL").alias("url"), F.col("pageURL").alias("page_url"), F.col("imageWidth").alias("width"), F.col("imageHeight").alias("height"), F.col("user").alias("author"), F.lit("Pixabay Content License").alias("license"), by("by ", F.col("user"), " via Pixabay").alias("attribution"), "views")
    return c.unionByName(m, allowMissingColumns=True).unionByName(p, allowMissingColumns=True)


def failure_cards(failures: DataFrame) -> DataFrame:
    """A failure as a card of the board; its entity comes from the task's name, in Portuguese or English."""
    attraction = F.col("task_name").rlike("(?i)attraction|atrativo")
    return failures.select("id", F.when(attraction, "atrativo").otherwise("destino").alias("type"), F.lit("falha").alias("column"), F.coalesce(filled(F.col("source_ref")), F.col("task_name")).alias("title"), F.coalesce("error", F.lit("")).alias("note"))


def prompt_context(name: Column, place: Column, uf: Column, kinds: Column, address: Column, reviews: Column) -> Column:
    """Lines for a writer: name, place, kinds, address and up to three review texts that are not empty."""
    texts = F.slice(F.filter(F.coalesce(reviews, F.array().cast("array<string>")), lambda t: F.coalesce(t, F.lit("")) != ""), 1, 3)
    return F.concat_ws("\n", F.concat(F.lit("Nome: "), name), F.concat(F.lit("Local: "), place, F.lit("/"), uf), F.when(F.size(kinds) > 0, F.concat(F.lit("Tipos: "), F.array_join(kinds, ", "))), F.concat(F.lit("Endereço: "), filled(address)), F.transform(texts, lambda t: F.concat(F.lit("- "), t)))


def push_payload(rows: DataFrame) -> DataFrame:
    """(source_ref, entity_type, payload) for the platform, the payload a struct of one shape: destinations leave the parts of
    attractions null. The parent falls back to the municipality's reference; hours that cannot be read are null."""
    source = F.coalesce(filled(F.split_part("source_ref", F.lit(":"), F.lit(1))), F.lit("unknown"))
    uf = F.split_part("source_ref", F.lit(":"), F.lit(2))
    attraction = F.col("entity_type") == "attraction"
    ibge = F.when(attraction, F.coalesce("municipio_id", "ibge_code")).otherwise(F.coalesce("ibge_code", "municipio_id"))
    parent = F.coalesce(filled(F.col("parent_source_ref")), F.concat(F.lit("ibge:"), uf, F.lit(":"), F.coalesce(ibge, F.lit("None"))))
    phone = scalars.split_phone(F.col("phone"))
    only = lambda x: F.when(attraction, x)
    payload = F.struct(
        source.alias("source"),
        F.when(attraction, F.coalesce("name", F.lit(""))).otherwise(F.coalesce("name", "municipio", F.lit(""))).alias("name"),
        only(first_filled(F.col("tipo"), F.lit("outros"))).alias("type"),
        ibge.alias("municipio_ibge"),
        only(first_filled(F.col("owner_phone"), phone["mobile"])).alias("whatsapp"),
        only(phone["landline"]).alias("telefone"),
        F.coalesce("score", F.lit(0.0)).alias("reliability_score"),
        only(F.struct(parent.alias("source_ref"), F.split_part(parent, F.lit(":"), F.lit(1)).alias("source"), F.coalesce("municipio", F.lit("")).alias("tourist_name"))).alias("destino"),
        only(scalars.price_level(F.col("price_level"))).alias("price_level"),
        only(hours.hours_map(F.col("weekday_text"))).alias("opening_hours"),
    )
    return rows.select("source_ref", "entity_type", payload.alias("payload"))
