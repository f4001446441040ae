"""Tables of many copies: rows that are alike meet others once, whatever their number."""

from pyspark.sql import functions as F

from varzea.operators import curation, enrich, neighbours, resolve
from varzea.streaming import machine


def most_rows(df):
    """The rows that the largest step of a query's plan gave."""
    df.collect()

    def walk(plan):
        metric = plan.metrics().get("numOutputRows")
        kids = plan.children()
        below = [walk(kids.apply(i)) for i in range(kids.size())]
        for inner in ("executedPlan", "plan"):
            if plan.getClass().getSimpleName() in {"executedPlan": ("AdaptiveSparkPlanExec",), "plan": ("ShuffleQueryStageExec", "BroadcastQueryStageExec")}[inner]:
                below.append(walk(getattr(plan, inner)()))
        return max([metric.get().value() if metric.isDefined() else 0, *below])

    return walk(df._jdf.queryExecution().executedPlan())


def copies(spark, n, names):
    return spark.range(n).select("id", F.lit("r").alias("block"), F.element_at(F.array(*(F.lit(x) for x in names)), (F.col("id") % len(names) + 1).cast("int")).alias("name"))


def test_copies_of_a_place(spark):
    rows = copies(spark, 400, ["praia do forte", "morro branco"])
    places = copies(spark, 600, ["praia do forte", "morro branco"]).select(F.col("id").alias("place_code"), F.col("name").alias("place_name"), F.col("block").alias("place_region"))
    found = resolve.fuzzy_place(rows, places, "id", "name", "block")
    assert most_rows(found) <= 2000
    assert {(r["id"], r["place_code"]) for r in found.collect()} == {(i, i % 2) for i in range(400)}


def test_copies_of_a_candidate(spark):
    rows = copies(spark, 400, ["praia do forte", "morro branco"]).withColumn("lat", F.when(F.col("id") % 5 > 0, 1.0)).withColumn("lng", F.lit(1.0))
    candidates = copies(spark, 600, ["praia do forte", "morro branco"]).select("block", F.col("name").alias("other"), F.col("id").alias("position"), F.when(F.col("id") < 300, 40.0).otherwise(1.0).alias("c_lat"), F.lit(1.0).alias("c_lng"))
    for km, first in ((None, 0), (100.0, 300)):
        found = resolve.best_match(rows, candidates, "block", "id", "name", "other", max_km=km)
        assert most_rows(found) <= 2000
        assert {(r["id"], r["position"], r["ratio"]) for r in found.collect()} == {(i, i % 2 + (first if i % 5 else 0), 100.0) for i in range(400)}


def test_copies_of_a_photograph(spark):
    rows = copies(spark, 300, ["praia do forte", "morro branco"]).select("id", "name", F.lit("bahia").alias("municipality"), F.lit("BA").alias("uf"))
    photos = copies(spark, 400, ["praia do forte", "morro branco"]).select(F.col("id").alias("photo"), (F.col("id") % 7).alias("area"), F.array("name").alias("categories"), F.lit("x").alias("object_name"))
    found = enrich.photo_matches(rows, photos)
    assert most_rows(found) <= 3000
    best = {k: sorted((-(p % 7), p) for p in range(400) if p % 2 == k)[:3] for k in (0, 1)}
    assert {(r["id"], r["photo"], r["rank"]) for r in found.collect()} == {(i, x[1], n) for i in range(300) for n, x in enumerate(best[i % 2], 1)}


def test_copies_of_a_vector(spark):
    """A search gives k rows for a query, those of the smallest ids, and none for rows that do not ask."""
    d = spark.range(500).select(F.col("id").cast("long").alias("id"), F.lit("u").alias("block"), F.array(F.lit(1.0), F.lit(0.0)).alias("v"))
    found = neighbours.nearest_by_cells(d, ["block"], "id", "v", 3, 0.5, asking=F.col("id") % 50 == 0)
    assert most_rows(found) <= 1500
    assert sorted((r["a"], r["b"]) for r in found.collect()) == [(a, b) for a in range(0, 500, 50) for b in [b for b in range(5) if b != a][:3]]


def test_address_is_read_before_the_order(spark):
    part = lambda kind, text: F.struct(F.array(F.lit(kind)).alias("types"), F.lit(text).alias("long_text"), F.lit(text).alias("short_text"))
    rows = spark.range(60).select((F.col("id") % 2).alias("query"), F.col("id").alias("position"), F.col("id").alias("place_id"), F.array(part("administrative_area_level_2", "m"), part("administrative_area_level_3", "d")).alias("components"))
    found = curation.search_results(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = [x for x in plan.splitlines() if "Window [" in x or "Sort [" in x]
    assert window and plan.index("Window [") < plan.index("filter(") and sorted(map(tuple, found.collect())) == [(q, p, p, "m", None, "d") for q in (0, 1) for p in range(q, 40, 2)]


class Handle:
    """A handle that counts timers."""

    def __init__(self):
        self.timers, self.values = [], {}

    def getValueState(self, name, schema):
        return Value()

    def getListState(self, name, schema):
        return Value()

    def registerTimer(self, ms):
        self.timers.append(ms)


class Value:
    def __init__(self):
        self.x = None

    def exists(self):
        return self.x is not None

    def get(self):
        return self.x

    def update(self, x):
        self.x = x

    put = update

    def appendList(self, x):
        self.x = (self.x or []) + x

    def clear(self):
        self.x = None


def test_one_timer_waits_for_a_key():
    import pandas as pd

    class Times:
        getExpiryTimeInMs = getCurrentWatermarkInMs = staticmethod(lambda: 5000)

    m, handle = machine.Machine(), Handle()
    m.init(handle)
    moves = pd.DataFrame({"at": pd.to_datetime([9000, 4000, 2000, 5000, 12000], unit="ms"), "id": range(5), "expected": None, "move": "discovered"})
    assert list(m.handleInputRows(("k",), iter([moves]), None)) == [] and handle.timers == [2000]
    assert list(pd.concat(m.handleExpiredTimer(("k",), Times, Times))["id"]) == [2, 1, 3] and handle.timers == [2000, 9000]
    late = moves.assign(at=pd.to_datetime([7000, 8000, 30000, 31000, 32000], unit="ms"))
    assert list(m.handleInputRows(("k",), iter([late]), None)) == [] and handle.timers == [2000, 9000, 7000]
