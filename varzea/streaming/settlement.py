"""Spend that is reserved when a call is made and settled when its bill comes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.streaming.stateful import floored_counters


def settlements(booked: DataFrame, bills: DataFrame, within: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(call, booked, settled, delta) of two streams: reservations (call, booked, reserved) and bills (bill, settled, actual), joined
    by the call within a span of time, so that the state of a reservation goes when no bill can come any more.

    A bill of the reservation's own day moves that day's counter by the difference, up or down. A later one finds the counter
    of that day gone: what was reserved too much is lost with it, what was spent beyond it counts on the day of the bill."""
    a, b = booked.withWatermark("booked", late), bills.withWatermark("settled", late)
    d = a.join(b, F.expr(f"call = bill AND settled >= booked AND settled <= booked + INTERVAL {within}"))
    difference = F.col("actual") - F.col("reserved")
    delta = F.when(F.to_date("booked") == F.to_date("settled"), difference).otherwise(F.greatest(F.lit(0), difference))
    return d.select("call", "booked", "settled", delta.cast("long").alias("delta"))


def daily_spend(booked: DataFrame, settled: DataFrame) -> DataFrame:
    """(day, spent) of the reservations and the settlements' moves in order of time; a counter never falls below zero."""
    moves = booked.select(F.col("booked").alias("at"), F.lit(0).alias("kind"), "call", F.col("reserved").alias("delta"))
    moves = moves.unionByName(settled.select(F.col("settled").alias("at"), F.lit(1).alias("kind"), "call", "delta"))
    days = moves.withColumn("day", F.date_format("at", "yyyy-MM-dd"))
    return floored_counters(days, "day", "at", ["kind", "call"], "delta").select("day", F.col("total").cast("long").alias("spent"))
