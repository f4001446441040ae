"""Landed reference files and pages as DataFrames, always with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.scalars import tourism_category

MUNICIPALITY = "ibge_code string, nome string, uf string, lat double, lng double"
DISTRICT = "distrito_code string, nome string, ibge_code string, municipio_nome string, uf string"
CATEGORY = "co_municipio string, no_municipio string, sg_uf string, categoria string, no_regiao_turistica string"
CARD = "name string, locationId bigint, rating double, review_count int, category string, lat double, lng double, phone string"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header, blanks around values stripped, a byte-order mark tolerated; unreadable lines stand in _corrupt_record."""
    return spark.read.schema(f"{schema}, _corrupt_record string").csv(path, header=True, enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", encoding="UTF-8")


def municipalities(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MUNICIPALITY)


def districts(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, DISTRICT)


def categories(spark: SparkSession, path: str) -> DataFrame:
    """Tourism categories with the label of each."""
    return read_csv(spark, path, CATEGORY).withColumn("label", tourism_category(F.col("categoria")))


def geo_ids(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object {uf: id} as rows."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,bigint>")).alias("uf", "geo_id"))


def sheet_rows(rows: DataFrame) -> DataFrame:
    """Rows of an exported sheet (uf, code, name): titles and footers dropped, codes that became floats repaired."""
    d = rows.withColumn("code", F.regexp_replace("code", r"\.0$", "")).withColumn("uf", F.regexp_replace("uf", r"\.0$", ""))
    return d.filter((F.length("uf") == 2) & F.col("uf").rlike(r"^\d+$") & (F.length("code") == 7))


def listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages (offset, cards) up to the first empty one of each listing; a row for each card with an id."""
    pages = spark.read.schema(f"listing string, offset bigint, cards array<struct<{_struct(CARD)}>>").json(path)
    empty = F.min(F.when(F.coalesce(F.size("cards"), F.lit(0)) == 0, F.col("offset"))).over(W.partitionBy("listing"))
    return pages.withColumn("_end", empty).filter(F.col("_end").isNull() | (F.col("offset") < F.col("_end"))).select("listing", "offset", F.explode("cards").alias("c")).select("listing", "offset", "c.*").filter("locationId IS NOT NULL")


def _struct(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split(" ") for f in ddl.split(", ")))


def component(components: str, kind: str):
    """The long text of the first address component of a kind."""
    return F.get(F.filter(components, lambda c: F.array_contains(c["types"], kind)), F.lit(0))["long_text"]


def geocode(rows: DataFrame, cache: DataFrame, key: str, now, ttl_days: int = 30) -> DataFrame:
    """Join a landed geocode cache; a fresh null answer counts as an answer (`known`), stale entries do not."""
    fresh = cache.filter(F.col("cached_at") >= now - F.expr(f"INTERVAL {ttl_days} DAY"))
    place = F.coalesce(*(F.nullif(c, F.lit("")) for c in ("municipality", "city", "town", "village", "county")))
    return rows.join(fresh.select(key, place.alias("place"), F.lit(True).alias("_hit")), key, "left").withColumn("known", F.coalesce("_hit", F.lit(False))).drop("_hit")


def first_known(rows: DataFrame, key: str, value: str, *tables: DataFrame, required: bool = False) -> DataFrame:
    """The value of the first table that has the key: cache, then table, then seed file. With `required` a key that none has fails the query."""
    out = rows
    for i, t in enumerate(tables):
        out = out.join(t.select(key, F.col(value).alias(f"_{i}")), key, "left")
    missing = [F.raise_error(F.concat(F.lit(f"no {value} for "), F.col(key).cast("string"))).cast(dict(out.dtypes)["_0"])] if required else []
    return out.withColumn(value, F.coalesce(*(f"_{i}" for i in range(len(tables))), *missing)).drop(*(f"_{i}" for i in range(len(tables))))


def cold_start_samples(rows: DataFrame, origin: float, seed: int = 42) -> DataFrame:
    """Simulated score inputs beside each row of a new source: completeness 60 to 100, recency 0 to 50."""
    return rows.withColumns({"origin": F.lit(origin), "completeness": F.rand(seed) * 40 + 60, "corroboration": F.lit(0.0), "recency": F.rand(seed + 1) * 50, "human": F.lit(0.0)})
