"""Structured Streaming queries. Each reads a table as a stream, runs to its end and returns what the sink holds."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.operators.rules import EDGES
from varzea.plans.bindings import table
from varzea.plans.registry import query
from varzea.sources import page_stream
from varzea.streaming import machine, settlement, stateful


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder where that is unset (local tests)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="varzea-stream-")).rstrip("/")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def run_to_end(rows: DataFrame, mode: str, keys: list[str] | None = None, good: Column | None = None) -> DataFrame:
    """Every micro-batch is written to the shared folder with its number. In update mode the last row of each key is
    returned. With `good`, rows that fail it are written aside, and come back with `aside` true."""
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/varzea-stream-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, base)

    def sink(batch: DataFrame, number: int) -> None:
        parts = {"out": batch} if good is None else {"out": batch.filter(good), "aside": batch.filter(~F.coalesce(good, F.lit(False)))}
        for name, part in parts.items():
            part.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")

    q = rows.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out").drop("batch")
    if good is not None:
        aside = spark.read.parquet(f"{base}/aside").drop("batch")
        return out.withColumn("aside", F.lit(False)).unionByName(aside.withColumn("aside", F.lit(True))).drop("_batch")
    if mode == "update":
        rest = [c for c in out.columns if c not in (*keys, "_batch")]
        out = out.groupBy(*keys).agg(*(F.max_by(c, "_batch").alias(c) for c in rest))
    return out.drop("_batch")


def delete_path(spark: SparkSession, path: str) -> None:
    """Best effort: when the driver ends the JVM may be gone already."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001
        pass


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling days; a day's state goes a day after its end, by the watermark."""
    e = stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 day")
    n = e.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    return run_to_end(n, "update", ["day", "event_type"]).select("day", "event_type", "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (reference, stage) passes once within the watermark of 31 days; older state goes."""
    e = stream(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("at")).withWatermark("at", "31 days")
    return run_to_end(e.dropDuplicatesWithinWatermark(["user_id", "event_type"]), "append").select("user_id", "event_type")


@query("SELECT event_id, value, event_type = 'error' OR event_type IS NULL AS aside FROM events")
def stream_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row isolation: failed rows go aside, the rest passes on."""
    return run_to_end(stream(spark, sf_dir, "events"), "append", good=F.col("event_type") != "error").select("event_id", "value", "aside")


_EXPECTS = "CASE WHEN event_id % 13 = 0 THEN 'contacts' ELSE CASE event_id % 7 WHEN 1 THEN 'discovered' WHEN 2 THEN 'signals' WHEN 3 THEN 'contacts' WHEN 4 THEN 'awaiting' WHEN 5 THEN 'awaiting' WHEN 6 THEN 'approved' END END"
_PAGED = "SELECT o_orderkey, o_orderkey % 4 AS listing, o_orderkey // 4000 AS page FROM orders WHERE NOT (o_orderkey % 4 = 2 AND o_orderkey // 4000 = 3)"


@query(f"SELECT 'l' || listing AS listing, CAST(page AS BIGINT) AS page, o_orderkey AS id FROM ({_PAGED}) WHERE NOT (listing = 2 AND page >= 3)")
def resumed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of four listings, one of which has an empty page; half of the pages land, the query stops, the rest lands,
    and a second query goes on from the checkpoint."""
    base = f"{shared_dir(spark)}/varzea-pages-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, base)
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k, F.concat(F.lit("l"), (k % 4).cast("string")).alias("listing"), F.floor(k / 4000).alias("page"))
    last = o.agg(F.max("page")).first()[0] or 0
    for number, part in enumerate([o.filter(F.col("page") <= last // 2), o.filter(F.col("page") > last // 2)]):
        page_stream.land(part.filter("NOT (listing = 'l2' AND page = 3)").select("listing", "page", F.struct(k.alias("locationId")).alias("card"), k.alias("place")), f"{base}/in")
        if number == 0:
            page_stream.land_empty(f"{base}/in", "l2", 3)
        q = page_stream.page_stream(spark, f"{base}/in").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.schema("listing string, page long, position int, card string").parquet(f"{base}/out")
    return out.select("listing", "page", F.get_json_object("card", "$.locationId").cast(dict(o.dtypes)["o_orderkey"]).alias("id"))


_MOVE = "CASE event_id % 7 WHEN 0 THEN 'discovered' WHEN 1 THEN 'signals' WHEN 2 THEN 'contacts' WHEN 3 THEN 'awaiting' WHEN 4 THEN 'approved' WHEN 5 THEN 'rejected' ELSE 'outreach' END"


_EDGES = " OR ".join(f"(s.st {'IS NULL' if a is None else f'= {a!r}'} AND m.mv = {b!r})" for a, b in EDGES)
_STATE = "{{'st': CAST({st} AS VARCHAR), 'mv': CAST({mv} AS VARCHAR), 'made': CAST({made} AS BIGINT), 'ignored': CAST({ignored} AS BIGINT)}}"


@query(
    f"""SELECT user_id, z.st AS state, z.made AS made, z.ignored AS ignored FROM (SELECT user_id, list_reduce(list_prepend({_STATE.format(st='NULL', mv='NULL', made=0, ignored=0)}, list({_STATE.format(st='NULL', mv='mv', made=0, ignored=0)} ORDER BY ts, event_id)),
 lambda s, m: CASE WHEN {_EDGES} THEN {_STATE.format(st='m.mv', mv='NULL', made='s.made + 1', ignored='s.ignored')} ELSE {_STATE.format(st='s.st', mv='NULL', made='s.made', ignored='s.ignored + 1')} END) AS z FROM (SELECT *, {_MOVE} AS mv FROM events) GROUP BY 1)"""
)
def state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded moves per reference, folded in order of time."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.expr(_MOVE).alias("move"))
    return stateful.machine_batch(e, "user_id", ["ts", "event_id"], "move")


_GUARDED = _STATE.replace("}}", ", 'ex': CAST({ex} AS VARCHAR)}}")


@query(
    f"""SELECT user_id, z.st AS state, z.made AS made, z.ignored AS ignored FROM (SELECT user_id, list_reduce(list_prepend({_GUARDED.format(st='NULL', mv='NULL', made=0, ignored=0, ex='NULL')}, list({_GUARDED.format(st='NULL', mv='mv', made=0, ignored=0, ex='ex')} ORDER BY date_trunc('millisecond', ts), event_id)),
 lambda s, m: CASE WHEN s.st IS NOT DISTINCT FROM m.ex AND ({_EDGES}) THEN {_GUARDED.format(st='m.mv', mv='NULL', made='s.made + 1', ignored='s.ignored', ex='NULL')} ELSE {_GUARDED.format(st='s.st', mv='NULL', made='s.made', ignored='s.ignored + 1', ex='NULL')} END) AS z FROM (SELECT *, {_MOVE} AS mv, {_EXPECTS} AS ex FROM events) GROUP BY 1)"""
)
def stage_machine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves that arrive up to twelve hours late, in slices of ten days, through a stateful processor with event-time timers; what
    its audit rows add up to. A last slice of no one's move, far ahead, lets the watermark pass all others."""
    moves = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").cast("long").alias("id"), F.expr(_EXPECTS).alias("expected"), F.expr(_MOVE).alias("move"))
    arrival = F.floor((F.unix_timestamp("at") + F.pmod(F.xxhash64("id"), F.lit(43_200))) / 864_000)
    landed = moves.withColumn("slice", arrival)
    end = landed.agg(F.max("at").alias("at")).select(F.lit(None).cast(dict(moves.dtypes)["key"]).alias("key"), (F.col("at") + F.expr("INTERVAL 9 DAYS")).alias("at"), F.lit(-1).cast("long").alias("id"), F.lit(None).cast("string").alias("expected"), F.lit("end").alias("move"))
    slices = [r["slice"] for r in landed.select("slice").distinct().orderBy("slice").collect()]  # slices of time: a handful
    base = f"{shared_dir(spark)}/varzea-moves-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, base)
    with machine.rocksdb(spark):
        end.limit(0).write.mode("append").parquet(f"{base}/in")
        audit = machine.audit_stream(spark.readStream.schema(end.schema).parquet(f"{base}/in"), "1 day")
        q = audit.writeStream.outputMode("append").format("parquet").option("path", f"{base}/audit").option("checkpointLocation", f"{base}/state").start()
        try:
            for rows in [*(landed.filter(F.col("slice") == s).drop("slice") for s in slices), end]:
                rows.write.mode("append").parquet(f"{base}/in")
                q.processAllAvailable()
        finally:
            q.stop()
    return machine.outcome(spark.read.parquet(f"{base}/audit")).filter("key IS NOT NULL").withColumnRenamed("key", "user_id")


@query(
    """WITH e AS (SELECT event_id, ts, CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents FROM events), s AS (SELECT event_id, ts + to_hours(CAST(event_id % 24 AS INTEGER)) AS due, ts AS booked, cents * (event_id % 5) // 2 - cents AS d FROM e WHERE event_id % 11 <> 0),
m AS (SELECT ts AS due, event_id, 0 AS kind, cents AS delta FROM e UNION ALL SELECT due, event_id, 1, CASE WHEN due::DATE = booked::DATE THEN d ELSE greatest(0, d) END FROM s)
SELECT strftime(due, '%Y-%m-%d') AS day, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list(CAST(delta AS BIGINT) ORDER BY due, kind, event_id)), lambda a, d: greatest(0, a + d)) AS BIGINT) AS spent FROM m GROUP BY 1"""
)
def settled_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations and their bills up to a day later, two streams joined in time; what each day has spent."""
    k, cents = F.col("event_id"), F.floor(F.col("value") * 100 + 0.5).cast("long")
    booked = lambda d: d.select(k.alias("call"), F.col("ts").cast("timestamp").alias("booked"), cents.alias("reserved"))
    bills = lambda d: d.filter(k % 11 != 0).select(k.alias("bill"), (F.col("ts").cast("timestamp") + F.make_dt_interval(hours=(k % 24).cast("int"))).alias("settled"), F.floor(cents * (k % 5) / 2).cast("long").alias("actual"))
    found = run_to_end(settlement.settlements(booked(stream(spark, sf_dir, "events")), bills(stream(spark, sf_dir, "events"))), "append")
    return settlement.daily_spend(booked(table(spark, sf_dir, "events")), found)


@query(
    """SELECT day, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list(delta ORDER BY ts, event_id)), lambda a, d: greatest(0, a + d)) AS BIGINT) AS total FROM
 (SELECT *, strftime(ts, '%Y-%m-%d') AS day, CAST(CASE WHEN event_type = 'error' THEN -3 ELSE 1 END * CAST(floor(value * 100 + 0.5) AS BIGINT) AS BIGINT) AS delta FROM events) GROUP BY 1"""
)
def floored_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counters of cents with refunds, never below zero."""
    cents = F.floor(F.col("value") * 100 + 0.5)
    e = table(spark, sf_dir, "events").select("ts", "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("event_type") == "error", cents * -3).otherwise(cents).alias("delta"))
    return stateful.floored_counters(e, "day", "ts", ["event_id"], "delta")


@query(
    """SELECT user_id, CAST(z.ok AS BIGINT) AS admitted, CAST(z.no AS BIGINT) AS refused FROM (SELECT user_id, list_reduce(list({'b': hit, 'n': 1, 'ok': 1, 'no': 0} ORDER BY hit),
 lambda s, t: CASE WHEN t.b - s.b >= 86400 THEN {'b': t.b, 'n': 1, 'ok': s.ok + 1, 'no': s.no} WHEN s.n < 10 THEN {'b': s.b, 'n': s.n + 1, 'ok': s.ok + 1, 'no': s.no} ELSE {'b': s.b, 'n': s.n + 1, 'ok': s.ok, 'no': s.no + 1} END) AS z
 FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS hit FROM events) GROUP BY 1)"""
)
def rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hits a day from the first hit on."""
    e = table(spark, sf_dir, "events").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    return stateful.fixed_window_limit(e, "user_id", "at", 86400, 10)


@query(
    """SELECT user_id, count(*) AS sessions, CAST(max(n) AS BIGINT) AS largest FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
 (SELECT user_id, ts, event_id, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS c FROM events)) GROUP BY 1, 2) GROUP BY 1"""
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation windows: a session ends after 12 hours of silence."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    s = e.groupBy("user_id", F.session_window("at", "12 hours").alias("w")).agg(F.count("*").alias("n"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("largest"))


@query("SELECT strftime(h, '%Y-%m-%d %H') AS window_start, CAST(sum(n) AS BIGINT) AS n FROM (SELECT date_trunc('hour', ts) AS hr, count(*) AS n FROM events GROUP BY 1) JOIN (SELECT unnest(range(0, 24)) AS k) ON true, LATERAL (SELECT hr - to_hours(CAST(k AS INTEGER)) AS h) GROUP BY 1")
def trailing_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of 24 hours, every hour."""
    e = table(spark, sf_dir, "events")
    hourly = e.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at")).agg(F.count("*").alias("n"))
    w = hourly.groupBy(F.window("at", "24 hours", "1 hour").alias("w")).agg(F.sum("n").alias("n"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH").alias("window_start"), "n")
