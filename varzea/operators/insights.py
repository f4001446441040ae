"""Read queries over the layers and logs: volumes, rates, costs, funnels, timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def zero_filled(counts: DataFrame, key: str, domain: list[str], count: str = "n") -> DataFrame:
    """A row for each value of a fixed domain; other values are dropped."""
    fixed = counts.sparkSession.createDataFrame([(v,) for v in domain], f"{key} string")
    return fixed.join(counts, key, "left").select(key, F.coalesce(count, F.lit(0)).cast("long").alias(count))


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def action_rates(rows: DataFrame, action: str) -> DataFrame:
    """Count and share of each action, 0 if there is none at all."""
    n = count_by(rows, action)
    total = F.sum("n").over(W.partitionBy())
    return n.withColumn("rate", F.floor(F.when(total == 0, F.lit(0.0)).otherwise(F.col("n") / total) * 10000 + 0.5) / 10000)


def costs(rows: DataFrame, key: str) -> DataFrame:
    """usd, tokens and calls per key; usd is an exact decimal."""
    return rows.groupBy(key).agg(F.sum("usd").alias("usd"), F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).cast("long").alias("tokens"), F.count("*").alias("calls"))


def cost_shares(cost: DataFrame) -> DataFrame:
    """Percent of the total, and a bar scaled to the largest, at least 2."""
    usd = F.col("usd").cast("double")
    every = W.partitionBy()
    share = F.try_divide(usd * 100, F.sum(usd).over(every))
    bar = F.greatest(F.lit(2.0), F.coalesce(F.try_divide(usd * 100, F.max(usd).over(every)), F.lit(0.0)))
    return cost.withColumn("share_pct", F.floor(share * 100 + 0.5) / 100).withColumn("bar_pct", F.floor(bar * 100 + 0.5) / 100)


def distribution(rows: DataFrame, score: str, routing: str) -> DataFrame:
    """n, shares of the two routes, mean and sample deviation of a score, two decimals; zeros without rows."""
    r2 = lambda x: F.floor(F.coalesce(x, F.lit(0.0)) * 100 + 0.5) / 100
    n = F.count("*")
    share = lambda v: r2(F.try_divide(F.count_if(F.col(routing) == v) * 100.0, n))
    return rows.agg(n.alias("n"), share("mar").alias("mar_pct"), share("dlq").alias("dlq_pct"), r2(F.avg(score)).alias("mean"), r2(F.stddev_samp(score)).alias("stdev"))


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


def last_known(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The last non-null value of each column along each key's timeline."""
    stamp = F.struct(*order)
    return rows.groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), stamp)).alias(c) for c in columns))


def runs_of_equal(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Gaps and islands: consecutive rows of one value, as (key, first, last, value, n)."""
    w = W.partitionBy(key).orderBy(order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    island = F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("_c", change).withColumn("_i", island).groupBy(key, "_i").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.first(value).alias(value), F.count("*").alias("n")).drop("_i")


def page(rows: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """A page of a total order; `order` must end in a unique column."""
    return rows.orderBy(*order).offset(offset).limit(limit)
