"""Running sums and interval sums by stretches: the same as a plain window and as comparing every pair."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from varzea.operators import lifecycle, scans
from varzea.streaming import stateful

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Nine in ten rows within one hour of the first day, a third of them at one instant."""
    rng = random.Random(6)
    out = []
    for i in range(3000):
        at = START + datetime.timedelta(hours=5, seconds=rng.choice([7, rng.randrange(3600), rng.randrange(3600)])) if rng.random() < 0.9 else START + datetime.timedelta(seconds=rng.randrange(3 * 86400))
        out.append((rng.choice(["a", "a", "a", "b", None]), at, i, rng.randrange(-3, 5)))
    return spark.createDataFrame(out, "k string, at timestamp_ntz, id long, v int"), out


@pytest.mark.parametrize("stretch", [100, 10**9])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_sums(rows, stretch, inclusive):
    df, plain = rows
    want, sums = {}, {}
    for k, at, i, v in sorted(plain, key=lambda r: (r[1], r[2])):
        want[i] = (sums.get(k, 0) + v * inclusive, sums.get((k, "n"), 0) + inclusive)
        sums[k], sums[k, "n"] = sums.get(k, 0) + v, sums.get((k, "n"), 0) + 1
    got = scans.running_sums(df, ["k"], ["at", "id"], {"s": F.col("v"), "n": F.lit(1)}, inclusive, stretch)
    assert {r["id"]: (r["s"], r["n"]) for r in got.collect()} == want


def test_stretches_are_even(rows):
    df, plain = rows
    n = [r["count"] for r in df.groupBy(scans.stretch_of(df, ["at", "id"], 100)).count().collect()]
    assert len(n) > 20 and max(n) < 0.15 * len(plain)


@pytest.mark.parametrize("stretch", [100, 10**9])
def test_interval_sums(spark, rows, stretch):
    df, plain = rows
    rng = random.Random(2)
    runs = []
    for i in range(200):
        a = START + datetime.timedelta(seconds=rng.randrange(3 * 86400)) if i % 3 else plain[i][1]
        runs.append((i, rng.choice(["a", "b"]), a, a + datetime.timedelta(seconds=rng.choice([-5, 0, 600, 86400]))))
    want = {i: sum(v for q, at, _, v in plain if q == k and a <= at <= b) for i, k, a, b in runs if a <= b}
    frame = spark.createDataFrame(runs, "run long, k string, started timestamp_ntz, ended timestamp_ntz")
    got = scans.interval_sums(frame, df.select("k", "at", "v"), "run", ["v"], ["k"], stretch=stretch)
    assert {r["run"]: r["v"] for r in got.collect()} == want


def test_floored_counters_and_engines(monkeypatch, rows):
    df, plain = rows
    floor = {}
    for k, _, _, v in sorted(plain, key=lambda r: (r[1], r[2])):
        floor[k] = max(0, floor.get(k, 0) + v)
    events = df.withColumn("event", F.when(F.col("v") > 0, "dispatch").when(F.col("v") < 0, "finish").otherwise("start")).withColumnRenamed("k", "engine")
    flight = {}
    for k, _, _, v in sorted(plain, key=lambda r: (r[1], r[2])):
        flight[k] = max(0, flight.get(k, 0) + (v > 0) - (v < 0))
    for stretch in (100, 10**9):
        monkeypatch.setattr(scans.running_sums, "__defaults__", (False, stretch))
        assert {r["k"]: r["total"] for r in stateful.floored_counters(df, "k", "at", ["id"], "v").collect()} == floor
        assert {r["engine"]: r["in_flight"] for r in lifecycle.engine_states(events).collect()} == flight
