"""Running sums over rows in order, where neither a day nor an hour nor an instant need fit one task.

The order is cut into stretches of about STRETCH rows at places taken from a bounded sample of the rows' own order values, so
that an hour with most of a day's rows has most of the cuts. Each stretch is summed; the stretches of a key, few and small, are
added up in order; rows are added up within their stretch. A table of one stretch is a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STRETCH, MOST_CUTS, PER_CUT = 500_000, 2_000, 10


def stretch_of(rows: DataFrame, order: list[str], stretch: int = STRETCH) -> Column | None:
    """The number of each row's stretch of the order, or None where there is one only. The order's values are compared as a
    struct; the cuts are at most MOST_CUTS of them, from PER_CUT times as many rows drawn by a hash of their values."""
    n = rows.count()
    cuts = min(MOST_CUTS, n // stretch)
    if not cuts:
        return None
    values = rows.select(*order).withColumn("_draw", F.xxhash64(*order)).orderBy("_draw").limit(cuts * PER_CUT)  # no more than MOST_CUTS * PER_CUT
    drawn = values.select(F.struct(*order).alias("x")).orderBy("x").collect()
    at = [drawn[i]["x"] for i in range(PER_CUT, len(drawn), PER_CUT)]
    kinds = dict(rows.dtypes)
    literal = lambda row: F.struct(*(F.lit(row[c]).cast(kinds[c]).alias(c) for c in order))
    if not at:
        return None
    edges = F.array(*map(literal, at))
    return F.size(F.filter(edges, lambda e: e < F.struct(*order)))


def running_sums(rows: DataFrame, key: list[str], order: list[str], values: dict[str, Column], inclusive: bool = False, stretch: int = STRETCH) -> DataFrame:
    """Add under each name the sum of its value over the key's rows before this one (with `inclusive`, up to it). Rows that tie
    in the order may come in any order. A null key is a key of its own."""
    d = rows.withColumns({f"_v_{n}": v for n, v in values.items()})
    end = 0 if inclusive else -1
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    part = stretch_of(rows, order, stretch)
    if part is None:
        w = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, end)
        return d.withColumns({n: total(f"_v_{n}", w) for n in values}).drop(*(f"_v_{n}" for n in values))
    d = d.withColumn("_part", part)
    sums = d.groupBy(*key, "_part").agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values))
    w = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(*(F.col(k).alias(f"_k_{k}") for k in key), F.col("_part").alias("_p"), *(total(f"_s_{n}", w).alias(f"_b_{n}") for n in values))
    inside = W.partitionBy(*key, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, end)
    d = d.withColumns({f"_i_{n}": total(f"_v_{n}", inside) for n in values})
    same = F.col("_part") == F.col("_p")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return d.join(before, same).withColumns({n: F.col(f"_b_{n}") + F.col(f"_i_{n}") for n in values}).select(*rows.columns, *values)


def interval_sums(runs: DataFrame, facts: DataFrame, run_id: str, values: list[str], key: list[str] | None = None, started: str = "started", ended: str = "ended", at: str = "at", stretch: int = STRETCH) -> DataFrame:
    """(run_id, values...) of runs with a start and an end: the sums of `values` over the facts from start to end, both included,
    of the run's key where one is given. Starts, facts and ends are sorted together once; what a run has is the running sum at
    its end less that at its start, so rows moved are runs and facts together, however the windows overlap."""
    key = key or []
    facts = facts.groupBy(*key, at).agg(*(F.sum(v).alias(v) for v in values))  # an instant is one row, however many facts it has
    zero = [F.lit(0).cast(dict(facts.dtypes)[v]).alias(v) for v in values]
    none = F.lit(None).cast(dict(runs.dtypes)[run_id]).alias("_run")
    edge = lambda c, kind: runs.filter(F.col(started) <= F.col(ended)).select(*key, F.col(c).alias("_at"), F.lit(kind).alias("_kind"), F.col(run_id).alias("_run"), *zero)
    every = edge(started, 0).unionByName(facts.select(*key, F.col(at).alias("_at"), F.lit(1).alias("_kind"), none, *values)).unionByName(edge(ended, 2))
    summed = running_sums(every, key, ["_at", "_kind"], {f"_r_{v}": F.col(v) for v in values}, stretch=stretch).filter("_kind <> 1")
    sign = F.when(F.col("_kind") == 2, 1).otherwise(-1)
    return summed.groupBy(F.col("_run").alias(run_id)).agg(*(F.sum(F.col(f"_r_{v}") * sign).alias(v) for v in values))
