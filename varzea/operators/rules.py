"""Rule cascades: gates, eligibility, transitions and decisions as ordered column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.operators.scans import running_sums

# Allowed moves between the stages of an attraction's review.
EDGES = [(None, "discovered"), ("discovered", "signals"), ("signals", "contacts"), ("contacts", "awaiting"), ("awaiting", "approved"), ("awaiting", "rejected"), ("approved", "outreach")]


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, null if none does. A null condition does not hold."""
    out = F
    for name, holds in rules:
        out = out.when(F.coalesce(holds, F.lit(False)), name)
    return out.otherwise(None)


def edge_allowed(spark, moves: DataFrame, before: str = "before", after: str = "after", edges=EDGES) -> DataFrame:
    """Add `allowed`: whether the move is one of the edges, null states compared as values."""
    e = spark.createDataFrame([(a, b, True) for a, b in edges], "_a string, _b string, _ok boolean")
    return moves.join(F.broadcast(e), moves[before].eqNullSafe(e["_a"]) & moves[after].eqNullSafe(e["_b"]), "left").withColumn("allowed", F.coalesce("_ok", F.lit(False))).drop("_a", "_b", "_ok")


def running(rows: DataFrame, day: str, at: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of `value` over the day's rows before each row, in the order (at, *order)."""
    return running_sums(rows, [day], [at, *order], {name: value})


def admitted(rows: DataFrame, day: str, at: str, order: list[str], cap: int, rejected: Column | None = None) -> DataFrame:
    """Add `admitted`: the first `cap` rows of each day; a row that is `rejected` gives its place back."""
    counts = F.lit(1) if rejected is None else F.when(F.coalesce(rejected, F.lit(False)), 0).otherwise(1)
    return running(rows, day, at, order, counts, "_sent").withColumn("admitted", F.col("_sent") < cap).drop("_sent")


def budget_blocked(rows: DataFrame, day: str, at: str, order: list[str], usd: str, budget: float) -> DataFrame:
    """Add spent (before the row, on its day) and blocked (spent + own cost reaches the budget)."""
    return running(rows, day, at, order, F.col(usd), "spent").withColumn("blocked", F.col("spent") + F.col(usd) >= budget)


def all_or_nothing(rows: DataFrame, group: str, reason: str) -> DataFrame:
    """Add `moved`: true for the rows of groups without any reason against."""
    return rows.withColumn("moved", F.count(reason).over(W.partitionBy(group)) == 0)


def weights_valid(weights: DataFrame) -> DataFrame:
    """Per config: each weight 0 to 100, and their sum 100 within 0.01."""
    return weights.groupBy("config").agg((F.bool_and(F.col("weight").between(0, 100)) & (F.abs(F.sum("weight") - 100) <= 0.01)).alias("valid"))
