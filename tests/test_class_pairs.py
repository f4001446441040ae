"""Pairs within blocks: every pair once, values compared once for each pair of classes of equal rows."""

from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from varzea.operators import resolve
from varzea.plans import registry


def test_pairs_of_a_block_are_all_there(spark):
    rows = [(i, "uv"[i % 2] if i % 9 else None, "x y z".split()[i % 3] if i % 5 else None, i % 4) for i in range(60)] + [(None, "u", "x", 1), (7, "v", "y", 1)]
    want = sorted((a[0], b[0], a[2] == b[2] and a[2] is not None) for a in rows for b in rows if a[1] and a[1] == b[1] and a[0] is not None and b[0] is not None and a[0] < b[0])
    d = spark.createDataFrame(rows, "id int, block string, v string, w int")
    compare = lambda x, y: [F.coalesce(x["v"] == y["v"], F.lit(False)).alias("same")]
    for tile in (3, 1000):
        assert sorted(map(tuple, resolve.pairs_by_class(d, ["block"], ["v", "w"], "id", compare, tile).collect())) == want


def test_copies_are_not_compared(spark):
    """Two classes of 1,500 rows each are three pairs of classes, cut into nine pairs of tiles or ten, not 4.5 million pairs of rows."""
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("boolean")
    def same(x: pd.Series, y: pd.Series) -> pd.Series:
        calls.add(len(x))
        return x == y

    d = spark.range(3000).select("id", F.lit("u").alias("block"), (F.col("id") % 2).cast("string").alias("v"))
    assert resolve.pairs_by_class(d, ["block"], ["v"], "id", lambda x, y: [same(x["v"], y["v"]).alias("same")]).groupBy("same").count().count() == 2
    assert calls.value <= 20


def test_many_copies_of_a_part(spark, tmp_path):
    """Forty copies of each part: the pairs and their fields as SQL has them."""
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(60)
    part.crossJoin(spark.range(40)).withColumn("p_partkey", F.col("p_partkey") + F.col("id") * 1000).drop("id").write.parquet(f"{tmp_path}/part.parquet")
    spark.read.parquet(f"{tmp_path}/part.parquet").createOrReplaceTempView("part")
    for name in ("matched_and_diverged", "token_jaccard_pairs"):
        a, b = ("a.p_partkey", "b.p_partkey")
        on = "a.p_name = b.p_name AND a.p_type = b.p_type" if name == "matched_and_diverged" else "a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size"
        want = spark.sql(f"SELECT {a} AS a, {b} AS b FROM part a JOIN part b ON {on} AND {a} < {b}")
        got = registry.queries()[name](spark, str(tmp_path))
        assert got.select("a", "b").exceptAll(want).isEmpty() and got.count() == want.count() > 40 * 60


def shuffled(df):
    """Bytes that the exchanges of a query's plan have written, a reused one once."""

    def walk(plan):
        kind, kids = plan.getClass().getSimpleName(), plan.children()
        below = [walk(kids.apply(i)) for i in range(kids.size())]
        for name, inner in (("AdaptiveSparkPlanExec", "executedPlan"), ("ResultQueryStageExec", "plan"), ("ShuffleQueryStageExec", "plan"), ("BroadcastQueryStageExec", "plan")):
            if kind == name:
                below.append(walk(getattr(plan, inner)()))
        return (plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0) + sum(below)

    return walk(df._jdf.queryExecution().executedPlan())


def test_pairs_are_not_shuffled(spark):
    """An id travels once in a block of one stripe, and not once for each other class of its block."""
    d = spark.range(6000).select("id", F.lit("u").alias("block"), (F.col("id") % 100).cast("string").alias("v"))
    pairs = resolve.pairs_by_class(d, ["block"], ["v"], "id", lambda x, y: [(x["v"] == y["v"]).alias("same")]).groupBy("same").count()
    assert dict(map(tuple, pairs.collect())) == {True: 100 * 60 * 59 // 2, False: 6000 * 5999 // 2 - 100 * 60 * 59 // 2}
    assert 0 < shuffled(pairs) < 40 * 6000


def test_pairs_are_written_in_few_bytes(spark, tmp_path):
    """The rows come in runs and repeated sequences, also where many blocks go through a task."""
    d = spark.range(24000).select("id", (F.col("id") % 10).cast("string").alias("block"), (F.col("id") % 70).cast("string").alias("v"))
    resolve.pairs_by_class(d, ["block"], ["v"], "id", lambda x, y: [(x["v"] == y["v"]).alias("same")]).write.parquet(f"{tmp_path}/pairs")
    n = spark.read.parquet(f"{tmp_path}/pairs").count()
    size = sum(f.stat().st_size for f in Path(f"{tmp_path}/pairs").glob("*.parquet"))
    assert n == 10 * 2400 * 2399 // 2 and size < 0.35 * n, size / n
