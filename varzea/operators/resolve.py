"""Entity resolution: blocked exact, fuzzy, vector and geographic joins."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.scalars import fold_key, haversine_km
from varzea.operators.matching import dimension, similar
from varzea.operators.neighbours import units
from varzea.shared import checkpointed

#: rows of a tile of a block of vectors
TILE_ROWS = 4_000
#: rows of a block that meet in a task, ids of equal rows that travel together, and pairs that a task writes out
STRIPE_ROWS, CLASS_TILE, TASK_PAIRS, MOST_TASKS = 30_000, 1_000, 20_000_000, 10_000


def exact_duplicates(rows: DataFrame, key: list[str], row_id: str) -> DataFrame:
    """Each row with the smallest other id of its key that precedes it, null for the first."""
    w = W.partitionBy(*key)
    least = F.min(row_id).over(w)
    return rows.withColumn("duplicate_of", F.when(F.col(row_id) > least, least))


def knn_in_block(rows: DataFrame, block: list[str], row_id: str, vector: str, k: int = 10, min_similarity: float = 0.95, tile: int = TILE_ROWS) -> DataFrame:
    """(block, a, b, similarity, rank): up to k other rows of the block with cosine similarity above the limit, exactly.

    A block of any size is cut into tiles of about `tile` rows. Each pair of tiles is a matrix product in its own task, which
    returns the k best of each of its rows; these are ranked over the pairs of tiles. Work is quadratic in a block, as exact
    neighbours are, but no task holds more than two tiles; `nearest_by_cells` is the approximate form. A vector of norm 0 or null
    has similarity 0 to all.
    """
    counts = rows.groupBy(*block).agg(F.ceil(F.count("*") / F.lit(tile)).alias("_tiles"))
    d = rows.select(*block, F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).join(counts, block)
    d = d.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_tiles"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)))
    d = d.select(*block, "id", "v", "_own", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"))
    kinds = dict(d.dtypes)
    fields = ", ".join(f"{c} {kinds[c]}" for c in block)

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["_own"].to_numpy()
        size = max((len(v) for v in pdf["v"] if v is not None), default=0)
        x = units(pdf["v"].tolist(), size)
        ids, low = pdf["id"].to_numpy(), own == pdf["_low"].iloc[0]
        one_tile = pdf["_low"].iloc[0] == pdf["_high"].iloc[0]
        sides = [(low, low)] if one_tile else [(low, ~low), (~low, low)]
        out = []
        for left, right in sides:
            here, there = np.flatnonzero(left), np.flatnonzero(right)
            for at in range(0, len(here), 512):
                part = here[at : at + 512]
                s = x[part] @ x[there].T
                if one_tile:
                    s[np.arange(len(part)), np.arange(at, at + len(part))] = -2
                enough = s > min_similarity
                if s.shape[1] > k:  # ties with the k-th stay, the final rank decides
                    enough &= s >= np.partition(s, s.shape[1] - k, axis=1)[:, -k][:, None]
                i, j = np.nonzero(enough)
                out.append(pd.DataFrame({"a": ids[part[i]], "b": ids[there[j]], "similarity": s[i, j]}))
        made = pd.concat(out)
        for c in block:
            made[c] = pdf[c].iloc[0]
        return made[[*block, "a", "b", "similarity"]]

    found = d.groupBy(*block, "_low", "_high").applyInPandas(best, f"{fields}, a {kinds['id']}, b {kinds['id']}, similarity double")
    w = W.partitionBy("a").orderBy(F.desc("similarity"), "b")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def exact_place(rows: DataFrame, places: DataFrame, name: str, region: str) -> DataFrame:
    """Add place_code by folded name and region; the last of equal names wins."""
    w = W.partitionBy("_key", "_region").orderBy(F.desc("place_code"))
    p = places.select("place_code", fold_key(F.col("place_name")).alias("_key"), F.col("place_region").alias("_region"))
    p = p.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    keyed = rows.withColumn("_key", fold_key(F.col(name))).withColumn("_region", F.col(region))
    return keyed.join(dimension(p), ["_key", "_region"], "left").drop("_key", "_region")


def fuzzy_place(rows: DataFrame, places: DataFrame, row_id: str, name: str, region: str, least: float = 88.0) -> DataFrame:
    """(id, place_code, ratio): the best place of the same region at or above the limit; the first of equals. Each distinct
    name of a region is looked up once, and compared with the distinct names of places that share enough of its rarest letter pairs."""
    asked = rows.select(F.struct(F.col(region).alias("region"), F.col(name).alias("name")).alias("id")).distinct()
    asked = checkpointed(asked.select("id", F.col("id.region").alias("block"), fold_key(F.col("id.name")).alias("name")))  # the join reads both sides several times
    first = checkpointed(places.groupBy(F.struct(F.col("place_region").alias("block"), fold_key(F.col("place_name")).alias("name")).alias("r")).agg(F.min("place_code").alias("place_code")))
    found = similar(asked, first.select(F.col("r").alias("id"), "r.block", "r.name"), least).join(first, "r")
    w = W.partitionBy("l").orderBy(F.desc("ratio"), "place_code")
    best = found.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(F.col("l.region").alias("_region"), F.col("l.name").alias("_name"), "place_code", "ratio")
    return rows.join(best, (rows[name] == best["_name"]) & (rows[region] == best["_region"])).select(rows[row_id], "place_code", "ratio")


def best_match(rows: DataFrame, candidates: DataFrame, block: str, row_id: str, name: str, other: str, least: float = 85.0, max_km: float | None = None) -> DataFrame:
    """Best candidate by token-set ratio; where both have coordinates, those too far away are passed over. Distinct names of a
    block are compared once, where they share enough letter pairs. Rows of the same name and coordinates have the same best
    candidate, and of candidates that are alike in both only the first can be it, so that these meet and not the rows."""
    named = lambda d, c: checkpointed(d.select(F.struct(F.col(block).alias("block"), F.col(c).alias("name")).alias("id")).distinct().select("id", "id.block", "id.name"))
    found = similar(named(rows, name), named(candidates, other), least, "set").select(F.col("l.block").alias(block), F.col("l.name").alias(name), F.col("r.name").alias(other), "ratio")
    asked_by, given_by = ([block, name], [block, other]) if max_km is None else ([block, name, "lat", "lng"], [block, other, "c_lat", "c_lng"])
    rest = [c for c in candidates.columns if c not in ("position", *given_by)]
    first = candidates.groupBy(*given_by).agg(F.min(F.struct("position", *rest)).alias("_first")).select(*given_by, "_first.*")
    pairs = rows.select(*asked_by).distinct().join(found, [block, name]).join(first, [block, other])
    if max_km is not None:
        far = haversine_km(F.col("lat"), F.col("lng"), F.col("c_lat"), F.col("c_lng")) > max_km
        pairs = pairs.filter(~F.coalesce(far, F.lit(False)))
    w = W.partitionBy(*asked_by).orderBy(F.desc("ratio"), "position")
    best = pairs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    best = best.withColumnsRenamed({c: f"_{c}" for c in asked_by})
    same = F.lit(True)
    for c in asked_by:  # a coordinate may be null
        same &= rows[c].eqNullSafe(best[f"_{c}"])
    pairs = rows.join(best, same).drop(*(f"_{c}" for c in asked_by))
    w = W.partitionBy(row_id).orderBy(F.desc("ratio"), "position")  # an id may have several names
    return pairs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def nearest_place(rows: DataFrame, places: DataFrame, row_id: str, max_km: float, region: str | None = None) -> DataFrame:
    """(id, place_code, km): the nearest place within max_km, of the same region if `region` is given.

    Places and rows meet by cells of max_km's width in latitude and, widened towards the poles, in longitude, so only
    neighbours are compared; the first of equals wins.
    """
    step = max_km / 111.0

    def across(band):
        """How many cells of longitude a band of latitude has."""
        edge = F.least(F.lit(90.0), F.greatest(F.abs(band * step), F.abs((band + 1) * step)) + step)
        return F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge)) / (1.1 * step))).cast("long")

    band = lambda lat: F.floor(lat / step).cast("long")
    column = lambda lng, n: F.pmod(F.floor((lng + 180) / 360 * n).cast("long"), n)
    p = places.select("place_code", F.col("place_region").alias("_region"), F.col("place_lat").alias("_lat"), F.col("place_lng").alias("_lng"))
    p = p.withColumn("_band", F.explode(F.array(*(band(F.col("_lat")) + d for d in (-1, 0, 1))))).withColumn("_n", across(F.col("_band")))
    p = p.withColumn("_cell", F.explode(F.array_distinct(F.array(*(F.pmod(column(F.col("_lng"), F.col("_n")) + d, F.col("_n")) for d in (-1, 0, 1)))))).drop("_n")
    r = rows.withColumn("_band", band(F.col("lat")))
    near = r.withColumn("_cell", column(F.col("lng"), across(F.col("_band")))).join(dimension(p), ["_band", "_cell"])
    if region:
        near = near.filter(F.col(region) == F.col("_region"))
    near = near.withColumn("km", haversine_km(F.col("lat"), F.col("lng"), F.col("_lat"), F.col("_lng"))).filter(F.col("km") <= max_km)
    w = W.partitionBy(row_id).orderBy("km", "place_code")
    return near.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(row_id, "place_code", "km")


def cascade(rows: DataFrame, row_id: str, stages: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """The first stage that knows the row's value, and its name under resolved_via. A stage is (id, value)."""
    out = rows
    for name, found in stages:
        out = out.join(found.select(row_id, F.col(value).alias(f"_{name}")), row_id, "left")
    via = F.coalesce(*(F.when(F.col(f"_{n}").isNotNull(), F.lit(n)) for n, _ in stages))
    return out.withColumn(value, F.coalesce(*(F.col(f"_{n}") for n, _ in stages))).withColumn("resolved_via", via).drop(*(f"_{n}" for n, _ in stages))


def code_diff(new: DataFrame, old: DataFrame, code: str, name: str) -> DataFrame:
    """Status of every code of either table: added, removed, renamed (by folded name), same."""
    n, o = new.select(code, F.col(name).alias("new_name")), old.select(code, F.col(name).alias("old_name"))
    status = F.when(F.col("old_name").isNull(), "added").when(F.col("new_name").isNull(), "removed").when(fold_key(F.col("new_name")) != fold_key(F.col("old_name")), "renamed").otherwise("same")
    return n.join(o, code, "full_outer").withColumn("status", status)


def missing_parents(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys of parents that children refer to and that do not exist yet."""
    return children.filter(F.col(key).isNotNull()).select(key).distinct().join(parents.select(key), key, "left_anti")


def pairs_by_class(rows: DataFrame, block: list[str], values: list[str], row_id: str, compare: Callable[[Column, Column], list[Column]], stripe: int = STRIPE_ROWS) -> DataFrame:
    """(a, b, *compared) of all pairs of a block's rows, a < b.

    Rows of a block with equal values are a class. `compare` takes the values of two classes, as structs, in either order, and is
    worked out once for each pair of classes, however many rows they have; ids travel in arrays of up to CLASS_TILE. A block of more
    than `stripe` rows is cut into stripes of about that many, and a task pairs two of them, so the largest block is spread.

    A row is shuffled once for each stripe of its block, which is once in blocks of up to `stripe` rows, and classes are made and
    paired where their rows then are; pairs are never shuffled. So the disk besides the output grows with the rows, and in larger
    blocks with the pairs divided by `stripe` / 2. A task holds two stripes, and of its output the rows of one id and one array.
    Rows without a block or an id meet none."""
    d = rows.dropna(subset=[*block, row_id]).select(*block, F.struct(*values).alias("_values"), F.col(row_id).alias("_id"))
    counts = d.groupBy(*block).agg(F.count("*").alias("_n"))
    most = counts.agg(F.sum(F.col("_n").cast("double") * F.col("_n")) / 2).first()[0] or 0.0
    tasks = int(min(MOST_TASKS, max(d.sparkSession.sparkContext.defaultParallelism, most // TASK_PAIRS)))
    large = counts.filter(F.col("_n") > stripe).select(*block, F.ceil(F.col("_n") / F.lit(stripe)).alias("_stripes"))
    d = d.join(dimension(large), block, "left").withColumn("_stripes", F.coalesce("_stripes", F.lit(1).cast("long")))
    d = d.withColumn("_own", F.pmod(F.xxhash64("_id"), F.col("_stripes"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_stripes") - 1)))
    meet = [*block, "_low", "_high"]
    d = d.select(*block, F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), "_own", "_values", "_id").repartition(tasks, *meet)
    classes = d.groupBy(*meet, "_own", "_values").agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
    starts = F.sequence(F.lit(1), F.size("_ids"), F.lit(CLASS_TILE))
    units = classes.select(*meet, "_own", "_values", F.posexplode(F.transform(starts, lambda i: F.slice("_ids", i, CLASS_TILE))).alias("_tile", "_ids"))
    units = units.select(*meet, F.col("_own").alias("_s"), F.struct("_values", "_tile").alias("_u"), F.col("_ids").alias("_left"))
    other = units.select(*meet, F.col("_s").alias("_t"), F.col("_u").alias("_v"), F.col("_left").alias("_right")).hint("merge")
    pairs = units.join(other, meet).filter("_s < _t OR (_s = _t AND _low = _high AND _u <= _v)")  # a condition on one side would part the sides' exchanges
    compared = compare(F.col("_u._values"), F.col("_v._values"))
    pairs = pairs.select(*compared, (F.struct("_s", "_u") == F.struct("_t", "_v")).alias("_own"), "_left", "_right", F.size("_right").alias("_n"))
    # The larger ids of the other side from the largest down, then the smaller ones from the smallest up: a and b are each a run of one
    # id or the start of one sequence, which Parquet keeps in few bytes.
    pairs = pairs.withColumn("_right", F.expr("CASE WHEN _own THEN reverse(_right) ELSE concat(reverse(_right), _right) END"))
    # An explode holds all that it makes of a row, and one that follows another all that it makes of all of those; a coalesce to as
    # many partitions moves nothing and hands rows on one by one.
    each = pairs.coalesce(tasks).withColumn("_x", F.explode("_left")).drop("_left").coalesce(tasks).select("*", F.posexplode("_right").alias("_at", "_y")).drop("_right")
    each = each.filter("CASE WHEN _at < _n THEN _x < _y ELSE _x > _y END")
    return each.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), *each.columns[: len(compared)])


def pair_candidates(rows: DataFrame, block: list[str]) -> DataFrame:
    """(block, candidates): how many pairs each block holds, whatever is made of them later."""
    n = F.count("*")
    return rows.groupBy(*block).agg((n * (n - 1) / 2).cast("long").alias("candidates"))
