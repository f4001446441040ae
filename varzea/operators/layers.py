"""Writers of the layered tables as pure functions: versioned raw rows, working rows, canonical rows, logs.

Every function returns what the table holds afterwards or what is to be appended; run twice on its own result it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.canonical import content_hash
from varzea.operators.gates import recent
from varzea.operators.records import canonical_map


def version_chain(rows: DataFrame, key: list[str], order: list[str], row_id: str = "id") -> DataFrame:
    """Version numbers and the pointer to the next version, per key."""
    w = W.partitionBy(*key).orderBy(*order)
    return rows.withColumn("version", F.row_number().over(w)).withColumn("superseded_by_id", F.lead(row_id).over(w))


def with_content_hash(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Add content_hash, of the payload's canonical JSON: the order of keys and the spelling of a text do not make a new version."""
    return rows.withColumn("content_hash", content_hash(F.col(payload), dict(rows.dtypes)[payload] == "string"))


def append_raw(incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """All versions after appending. A content hash that any version of the same (source, source_ref) has had is no new version."""
    rows = incoming if existing is None else incoming.unionByName(existing.select(*incoming.columns))
    first = W.partitionBy("source", "source_ref", "content_hash").orderBy("ingested_at", "id")
    fresh = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return version_chain(fresh, ["source", "source_ref"], ["ingested_at", "id"])


def active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("superseded_by_id").isNull())


def insert_working(candidates: DataFrame, existing: DataFrame | None, refresh_on_new_version: bool = False) -> DataFrame:
    """One working row per canonical_key: what exists stays, else the first version (the last with `refresh_on_new_version`)."""
    order = F.desc("version") if refresh_on_new_version else F.asc("version")
    pick = candidates.withColumn("_n", F.row_number().over(W.partitionBy("canonical_key").orderBy(order))).filter("_n = 1").drop("_n")
    return pick if existing is None else pick.join(existing.select("canonical_key"), "canonical_key", "left_anti")


def merge_changed(current: Column, before: Column, after: Column) -> Column:
    """Keys that `after` has changed against `before`, put into `current`; keys are never deleted."""
    changed = F.map_filter(after, lambda k, v: ~F.coalesce(v.eqNullSafe(F.try_element_at(before, k)), F.lit(False)))
    kept = F.map_filter(current, lambda k, v: ~F.map_contains_key(changed, k))
    return F.map_concat(kept, changed)


def promote(candidates: DataFrame, canonical: DataFrame) -> DataFrame:
    """Rows to append to the canonical layer: new keys and those whose content differs from their active version."""
    last = active(canonical).select("source_ref", F.col("content").alias("_content"), F.col("version").alias("_version"))
    joined = candidates.join(last, "source_ref", "left").filter(~F.col("content").eqNullSafe(F.col("_content")))
    return joined.withColumn("version", F.coalesce("_version", F.lit(0)) + 1).drop("_content", "_version")


def append_once(incoming: DataFrame, existing: DataFrame | None, key: list[str], order: list[str]) -> DataFrame:
    """The first incoming row of each key that the table does not have."""
    first = incoming.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")
    return first if existing is None else first.join(existing.select(*key).distinct(), key, "left_anti")


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Last write wins."""
    return changes.unionByName(table.join(changes.select(key), key, "left_anti").select(*changes.columns))


def seed_absent(table: DataFrame, defaults: DataFrame, key: str) -> DataFrame:
    return table.unionByName(defaults.join(table.select(key), key, "left_anti").select(*table.columns))


def retain(events: DataFrame, cutoff: Column, keep_status: str = "fail") -> DataFrame:
    """Drop old events but keep failures for ever."""
    return events.filter(~((F.col("status") != keep_status) & (F.col("created_at") < cutoff)))


def newest(rows: DataFrame, partition: list[str], order: list[Column], n: int) -> DataFrame:
    """The n first rows of each group; Spark limits each group before the sort's shuffle."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*partition).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def quarantine(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a row that breaks rules goes to `bad` with the names of all of them."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items())), lambda x: x.isNotNull())
    judged = rows.withColumn("broken_rules", broken)
    return judged.filter(F.size("broken_rules") == 0).drop("broken_rules"), judged.filter(F.size("broken_rules") > 0)


def content_key(canonical: Column, *more: Column) -> Column:
    """A hash of a map's entries in order of their keys, and of further columns."""
    return F.sha2(F.to_json(F.struct(F.array_sort(F.map_entries(canonical)).alias("entries"), *more)), 256)


def promote_records(rows: DataFrame, canonical: DataFrame, now: Column) -> DataFrame:
    """Add routing, dlq_reason, canonical, content and version to (entity_type, source_ref, normalized, score, newest_review) rows:
    attractions without a review of the last 90 days go to review, what is equal to its active version gets none, else a
    new version follows the active one."""
    held = (F.col("entity_type") == "attraction") & ~recent(F.col("newest_review"), now, 90)
    d = rows.withColumn("routing", F.when(held, "dlq").otherwise("mar")).withColumn("dlq_reason", F.when(held, "no_recent_reviews"))
    d = d.withColumn("canonical", F.when(~held, canonical_map(F.col("normalized")))).withColumn("content", F.when(~held, content_key(F.col("canonical"), F.col("score"))))
    last = active(canonical).select("source_ref", F.col("content").alias("_content"), F.col("version").alias("_version"))
    new = ~held & ~F.col("content").eqNullSafe(F.col("_content"))
    return d.join(last, "source_ref", "left").withColumn("version", F.when(new, F.coalesce("_version", F.lit(0)) + 1)).drop("_content", "_version")
