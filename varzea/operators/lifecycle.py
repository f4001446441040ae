"""Runs, logs, consents, batches, retries and settings: their tables as pure functions of what came before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.scalars import redact
from varzea.operators.rules import first_reason, running
from varzea.operators.scans import interval_sums, running_sums

# Placeholders of a batch that is being claimed, and of one that may or may not exist.
CLAIM, AMBIGUOUS = "claiming", "ambiguous"
MAX_ATTEMPTS, MAX_EXPIRIES, REAP_HOURS, RETRIES = 3, 2, 25, 3
PAGE, MAX_TURNS = 30, 3


def audit(changes: DataFrame, action: Column, actor: str) -> DataFrame:
    """Audit rows of (entity_type, record_id, before, after, at) changes; a change without an effect leaves none."""
    return changes.filter(~F.col("before").eqNullSafe(F.col("after"))).select(action.alias("action"), "entity_type", "record_id", "before", "after", F.lit(actor).alias("actor"), "at")


def upsert_consents(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Add `outcome` to (phone, at) requests: refused for a phone that has opted out, touched where an active row exists
    (active_id is the latest), else inserted. Requests of one phone count once, the first."""
    w = W.partitionBy("phone").orderBy("at", "id")
    once = requests.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    state = log.groupBy("phone").agg(F.bool_or("opted_out").alias("_out"), F.max_by(F.when(~F.col("opted_out"), F.col("consent_id")), F.when(~F.col("opted_out"), F.struct("first_contact", "consent_id"))).alias("active_id"))
    outcome = first_reason([("refused", F.col("_out")), ("touched", F.col("active_id").isNotNull())])
    return once.join(state, "phone", "left").withColumn("outcome", F.coalesce(outcome, F.lit("inserted"))).withColumn("active_id", F.when(F.col("outcome") == "touched", F.col("active_id"))).drop("_out")


def opt_out(log: DataFrame, phones: DataFrame) -> DataFrame:
    """All rows of the phones are marked; a phone without a row gets one."""
    out = phones.select("phone").distinct().withColumn("_out", F.lit(True))
    marked = log.join(out, "phone", "left").withColumn("opted_out", F.coalesce("_out", "opted_out")).drop("_out")
    new = out.join(log.select("phone").distinct(), "phone", "left_anti").withColumnRenamed("_out", "opted_out")
    return marked.unionByName(new, allowMissingColumns=True)


def seed_if_empty(table: DataFrame, seed: DataFrame) -> DataFrame:
    """The table, or the seed's rows where it has none."""
    return seed.select(*table.columns) if table.isEmpty() else table


def merged_places(new: DataFrame, old: DataFrame, code: str = "code") -> DataFrame:
    """Codes and names of the new table; positions of the old one, null for codes that it lacks."""
    return new.join(old.select(code, "lat", "lng"), code, "left").select(code, "name", "lat", "lng")


def run_envelopes(starts: DataFrame, ends: DataFrame, now: Column) -> DataFrame:
    """Runs with their end and status: partial if a stop drained them, running if they have no end yet (`until` is now then)."""
    e = ends.groupBy("run_id").agg(F.max("at").alias("ended"), F.max_by("state", "at").alias("state"), F.max_by("dispatched", "at").alias("dispatched"))
    status = F.when(F.col("ended").isNull(), "executando").when(F.col("state") == "stopping", "parcial").otherwise("concluido")
    return starts.join(e, "run_id", "left").select("run_id", "started", "ended", F.coalesce("ended", now).alias("until"), F.coalesce("dispatched", F.lit(0)).alias("dispatched"), status.alias("status"))


def run_totals(runs: DataFrame, published: DataFrame, routed: DataFrame, poison: DataFrame) -> DataFrame:
    """synced, failed and total of each run's window: published rows, routed rows of dlq or descarte, and quarantined rows, in one
    sweep over the windows' ends and the facts."""
    fact = lambda rows, synced, failed: rows.select("at", F.lit(synced).cast("long").alias("synced"), F.lit(failed).cast("long").alias("failed"))
    facts = fact(published, 1, 0).unionByName(fact(routed.filter(F.col("routing").isin("dlq", "descarte") & F.col("at").isNotNull()), 0, 1)).unionByName(fact(poison, 0, 1))
    n = interval_sums(runs, facts, "run_id", ["synced", "failed"], ended="until")
    out = runs.join(n, "run_id", "left").withColumn("synced", F.coalesce("synced", F.lit(0))).withColumn("failed", F.coalesce("failed", F.lit(0)))
    return out.withColumn("total", F.col("synced") + F.col("failed"))


def rerun_scope(runs: DataFrame, lanes: list[str]) -> DataFrame:
    """(run_id, uf, lane): the dispatch list of a past run, its regions with each of its lanes that is still known."""
    d = runs.select("run_id", F.explode("ufs").alias("uf"), "lanes")
    return d.select("run_id", "uf", F.explode(F.array_intersect("lanes", F.array(*map(F.lit, lanes)))).alias("lane"))


def resume(pages: DataFrame, total: DataFrame) -> DataFrame:
    """Per listing the offset and number of the page to go on with, and whether it is done: the first page that is missing
    after the pages recorded without a gap."""
    w = W.partitionBy("listing").orderBy("offset")
    seen = pages.select("listing", "offset").distinct().withColumn("_gap", F.col("offset") != (F.row_number().over(w) - 1) * PAGE)
    last = seen.groupBy("listing").agg(F.max(F.when(~F.col("_gap"), F.col("offset"))).alias("last"))
    out = total.join(last, "listing", "left")
    page = F.coalesce(F.floor(F.col("last") / PAGE) + 2, F.lit(1))
    return out.select("listing", ((page - 1) * PAGE).cast("long").alias("next_offset"), page.cast("long").alias("next_page"), (page > F.col("pages")).alias("done"))


def progress(pages: DataFrame, total: DataFrame) -> DataFrame:
    """Per listing pages done, cards and errors so far, and percent; zeros for one that has not begun."""
    n = pages.groupBy("listing").agg(F.count("*").alias("done"), F.sum("cards").alias("cards"), F.sum("errors").alias("errors"))
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return total.join(n, "listing", "left").select("listing", z("done"), z("cards"), z("errors"), F.least(F.lit(100.0), F.floor(F.coalesce("done", F.lit(0)) * 1000.0 / F.col("pages") + 0.5) / 10).alias("percent"))


def engine_states(log: DataFrame) -> DataFrame:
    """Per engine its state after all events: running from start to the moment when, after a stop or not, nothing is in flight
    any more; in flight never falls below zero. The floored counter is the sum less its least prefix sum below zero."""
    delta = F.when(F.col("event") == "dispatch", 1).when(F.col("event") == "finish", -1).otherwise(0)
    run = running_sums(log.withColumn("_d", delta), ["engine"], ["at", "id"], {"_sum": F.col("_d")}, inclusive=True)
    stamp = F.struct("at", "id")
    last = lambda e: F.max(F.when(F.col("event") == e, stamp))
    g = run.groupBy("engine").agg((F.sum("_d") - F.least(F.lit(0), F.min("_sum"))).alias("in_flight"), last("start").alias("_start"), last("stop").alias("_stop"))
    state = F.when(F.col("_start").isNull(), "idle").when(F.col("in_flight") == 0, "idle").when(F.coalesce(F.col("_stop") > F.col("_start"), F.lit(False)), "stopping").otherwise("running")
    return g.select("engine", F.col("in_flight").cast("long").alias("in_flight"), state.alias("state"))


def conversation_step(opted_out: Column, exists: Column, works: Column, turns: Column) -> Column:
    """What follows a reply: finalize after an opt-out, with both answers, or after the last turn; else a further question."""
    done = opted_out | ((exists != "") & (works != "")) | (turns >= MAX_TURNS)
    return F.when(F.coalesce(done, F.lit(False)), "finalize").otherwise("ask_followup")


def owner_outcome(opted_out: Column, exists: Column, works: Column) -> Column:
    """owner_opted_out and owner_no_answer go to review; a confirmed record is scored with the human criterion at 100."""
    confirmed = (exists == "sim") & works.isin("sim", "temporariamente_fechado")
    return F.when(F.coalesce(opted_out, F.lit(False)), "owner_opted_out").when(F.coalesce(confirmed, F.lit(False)), "confirmed").otherwise("owner_no_answer")


def reaped(rows: DataFrame, gone: DataFrame, now: Column) -> DataFrame:
    """Add `freed`: a stamp older than REAP_HOURS whose batch is known to be gone, or that was only being claimed."""
    stale = F.coalesce(F.col("submitted") < now - F.make_interval(hours=F.lit(REAP_HOURS)), F.lit(False))
    g = gone.select("batch_id").distinct().withColumn("_gone", F.lit(True))
    free = stale & ((F.col("batch_id") == CLAIM) | F.coalesce("_gone", F.lit(False)))
    return rows.join(g, "batch_id", "left").withColumn("freed", F.coalesce(free, F.lit(False))).drop("_gone")


def collected(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Rows after their results: a result counts only while the row bears its batch's stamp, and clears it. What was billed
    (succeeded, errored) costs an attempt unless it brought a text, what was not (expired, canceled) an expiry."""
    r = results.select(F.col("id").alias("_id"), F.col("batch_id").alias("_batch"), "type", "text").dropDuplicates(["_id", "_batch"])
    d = rows.join(r, (F.col("id") == F.col("_id")) & (F.col("batch_id") == F.col("_batch")), "left")
    hit, got = F.col("_batch").isNotNull(), F.coalesce(F.col("text"), F.lit("")) != ""
    billed = F.col("type").isin("succeeded", "errored")
    done = F.coalesce(hit & (F.col("type") == "succeeded") & got, F.lit(False))
    return d.select(
        "id",
        F.when(hit, F.lit(None)).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(done, F.col("text")).otherwise(F.col("description")).alias("description"),
        (F.coalesce("attempts", F.lit(0)) + F.when(hit & billed & ~done, 1).otherwise(0)).alias("attempts"),
        (F.coalesce("expiries", F.lit(0)) + F.when(hit & ~billed, 1).otherwise(0)).alias("expiries"),
    )


def never_billed(error: Column, status: Column) -> Column:
    """A failed request that surely made no batch: no connection, or refused by a status below 500. A timeout is no such case."""
    return F.coalesce(F.when(error == "timeout", False).when(error == "connection", True).when(error == "status", status < 500), F.lit(False))


def retry_outcome(attempts: DataFrame) -> DataFrame:
    """Per task done, retry (with the delay before the next try, doubling) or quarantined: after a permanent failure at once,
    after a transient one when RETRIES retries are used up."""
    g = attempts.groupBy("task").agg(F.bool_or(F.col("result") == "ok").alias("ok"), F.bool_or(F.col("result") == "permanent").alias("permanent"), F.count_if(F.col("result") == "transient").alias("failed"))
    outcome = F.when(F.col("ok"), "done").when(F.col("permanent") | (F.col("failed") > RETRIES), "quarantined").otherwise("retry")
    return g.select("task", outcome.alias("outcome"), F.when(outcome == "retry", F.pow(F.lit(2), F.col("failed") - 1) * 60).cast("long").alias("delay_s"))


def settings(rows: DataFrame, allowed: dict[str, list[str]], defaults: dict[str, str]) -> DataFrame:
    """(scope, key, value, fallback): the default stands in for a value that is missing or not allowed."""
    ok = F.coalesce(*(F.when(F.col("key") == k, F.col("value").isin(v)) for k, v in allowed.items()), F.lit(False))
    default = F.coalesce(*(F.when(F.col("key") == k, F.lit(v)) for k, v in defaults.items()))
    return rows.withColumn("fallback", ~F.coalesce(ok, F.lit(False))).withColumn("value", F.when(F.col("fallback"), default).otherwise(F.col("value")))


def enabled(flags: Column, order: list[str]) -> Column:
    """The keys of a map of flags that are set, in the order of declaration."""
    return F.filter(F.array(*map(F.lit, order)), lambda k: F.coalesce(F.try_element_at(flags, k), F.lit(False)))


def config_snapshot(rows: DataFrame, secret: str = "(?i)key|token|secret|password") -> DataFrame:
    """Settings with secrets masked."""
    return rows.withColumn("value", F.when(F.col("key").rlike(secret), redact(F.col("value"))).otherwise(F.col("value")))


def tracked_calls(calls: DataFrame, day: str, budget: float) -> DataFrame:
    """Calls with what the day has spent on the calls before, and whether the check lets each pass. Every call counts as planned."""
    return running(calls, day, "at", ["id"], F.col("usd"), "spent").withColumn("passes", F.col("spent") + F.col("usd") < budget)
