"""Queries of scalar functions on texts, phones, scores, times and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.functions import hours, scalars
from varzea.plans.bindings import table
from varzea.plans.registry import query
from varzea.sources import pages as page_source


@query("SELECT p_partkey, regexp_replace(trim(lower(p_name)), '[^a-z0-9]+', '-', 'g') AS slug, lower(p_name) AS fold FROM part")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", scalars.slug(F.col("p_name")).alias("slug"), scalars.fold_key(F.col("p_name")).alias("fold"))


@query("SELECT n_nationkey, list_aggregate(list_transform(string_split(n_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS name FROM nation")
def title_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", scalars.normalize_name(F.concat(F.lit("  "), F.regexp_replace("n_name", " ", " \t "), F.lit(" "))).alias("name"))


# spellings of a customer's number, K being its key in four digits; an even key makes a mobile number of the first ones
_SPELLED = [
    "+55 73 99999-K", "+55 27 3329-K", "7399999K", "739 9999-K", "+1 415 555 K", "+1 491 555 K", "+351 912 345 K", "55739999K9", "5573 9 9999 K", "12-K", "no number", "", None, "+55 11 98765", "(73) 9 9999-K", "0800 K", "+55 (73) 3222.K", "1 491 555 K",
]
_SPELLED_SQL = "CASE c_custkey % " + str(len(_SPELLED)) + " " + " ".join(f"WHEN {i} THEN " + ("NULL" if s is None else "replace('" + s + "', 'K', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0'))") for i, s in enumerate(_SPELLED)) + " END"


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with numbers in many spellings, of Brazil and of other countries, some that are none."""
    k = F.col("c_custkey")
    texts = F.array(*(F.lit(s) for s in _SPELLED))
    return table(spark, sf_dir, "customer").select(k, F.replace(F.get(texts, (k % len(_SPELLED)).cast("int")), F.lit("K"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("p"))


@query(
    f"""WITH p AS (SELECT c_custkey, {_SPELLED_SQL} AS p FROM customer), d AS (SELECT *, regexp_replace(p, '[^0-9]', '', 'g') AS d, regexp_replace(p, '[^0-9+]', '', 'g') AS e FROM p),
n AS (SELECT *, CASE WHEN length(d) IN (12, 13) AND d[:2] = '55' THEN d[3:] WHEN length(d) IN (10, 11) THEN d END AS n, p[1] = '+' AND d[:2] <> '55' AS abroad FROM d),
m AS (SELECT *, CASE WHEN NOT abroad AND n IS NOT NULL THEN '+55' || n END AS f, coalesce(NOT abroad AND length(n) = 11 AND n[3] = '9', false) AS mobile FROM n)
SELECT c_custkey, CASE WHEN length(p) <= 6 THEN '***' ELSE p[:5] || '*****' || p[-2:] END AS masked, CASE WHEN mobile AND n[1] <> '0' THEN f[:5] || '*****' || f[-2:] END AS candidate, CASE WHEN mobile THEN f END AS mobile,
 CASE WHEN NOT mobile AND length(d) > 0 THEN coalesce(f, p) END AS landline, CASE WHEN e[1] = '+' THEN e WHEN length(e) IN (10, 11) THEN '+55' || e WHEN e[:2] = '55' AND length(e) IN (12, 13) THEN '+' || e END AS e164 FROM m"""
)
def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    parts = scalars.split_phone(p)
    return spelled(spark, sf_dir).select("c_custkey", scalars.mask_phone(p).alias("masked"), scalars.whatsapp_candidate(p).alias("candidate"), parts["mobile"].alias("mobile"), parts["landline"].alias("landline"), scalars.phone_e164(p).alias("e164"))


_CALLS = ["11987654321", "(73) 9 9999-0001", "+55 73 9 9999-0001", "73\t3222\t1111", "+55 73 99999-0001 or (73) 3222.1111", "room 12-34 at 9", "1234567", "123456789", "a 1 2 3 4 5 6 7 8 9 b", "7" * 600]


@query(
    "SELECT event_id, regexp_replace('call ' || props || ' ' || [" + ", ".join("'" + c.replace("\t", "' || chr(9) || '") + "'" for c in _CALLS) + "][event_id % " + str(len(_CALLS)) + " + 1] || repeat(' end', CAST(event_id % 3 * 80 AS INT)), '\\+?[0-9][0-9\\s().-]{7,}[0-9]', '[redacted]', 'g')[:500] AS clean FROM events"
)
def scrub_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in groups of any size, without blanks, with tabs; and digits that are too few."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    text = F.concat(F.lit("call "), F.col("props"), F.lit(" "), F.get(F.array(*map(F.lit, _CALLS)), (k % len(_CALLS)).cast("int")), F.repeat(F.lit(" end"), (k % 3 * 80).cast("int")))
    return e.select("event_id", scalars.scrub(text).alias("clean"))


@query("SELECT p_partkey, CASE WHEN n IS NULL OR n <= 0 THEN 0.0 ELSE floor(least(100.0, 100.0 * ln(1 + n::DOUBLE) / ln(501.0)) * 100 + 0.5) / 100 END::DOUBLE AS corroboration, CASE WHEN n <= 30 THEN 100.0 WHEN n <= 180 THEN 70.0 WHEN n <= 365 THEN 40.0 WHEN n <= 730 THEN 20.0 ELSE 0.0 END::DOUBLE AS recency FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size * 20 - 100 END AS n FROM part)")
def score_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from below zero to a thousand, and none."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size") * 20 - 100).alias("n"))
    return p.select("p_partkey", scalars.corroboration_from_reviews(F.col("n")).alias("corroboration"), scalars.recency_steps(F.col("n")).alias("recency"))


@query("SELECT o_orderkey, CASE WHEN age <= 30 THEN 100 WHEN age <= 180 THEN 70 WHEN age <= 365 THEN 40 WHEN age <= 730 THEN 20 ELSE 0 END::DOUBLE AS recency FROM (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01') AS age FROM orders)")
def recency_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.date_diff(F.to_date(F.lit("2001-09-01")), F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.recency_steps(age).alias("recency"))


@query("SELECT c_custkey, floor((2 + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END)::DOUBLE / 6 * 80 * 100 + 0.5) / 100 AS completeness FROM customer")
def completeness_of_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name and a number, an empty text and a null, a text and an array that are filled in some rows."""
    k = F.col("c_custkey")
    texts = F.when(k % 5 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    fields = [F.col("c_name"), F.col("c_acctbal") * 0, F.lit(""), F.lit(None), F.when(k % 3 == 0, F.col("c_name")), texts]
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.completeness(fields, 80.0).alias("completeness"))


@query("SELECT event_id, 86400 - (hour(ts) * 3600 + minute(ts) * 60 + CAST(second(ts) AS BIGINT)) AS left_s, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def day_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", scalars.seconds_to_midnight(F.col("ts")).cast("long").alias("left_s"), F.to_date("ts").cast("string").alias("day"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Turistico' WHEN 1 THEN 'Complementar' ELSE 'Apoio' END AS label, split_part('tripadvisor:attraction:' || CAST(s_suppkey AS VARCHAR), ':', 1) AS source FROM supplier")
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = F.when(k % 3 == 0, "Municípios Turísticos").when(k % 3 == 1, "c ").otherwise("E")
    return table(spark, sf_dir, "supplier").select(k, scalars.tourism_category(raw).alias("label"), scalars.source_of_key(F.concat(F.lit("tripadvisor:attraction:"), k.cast("string"))).alias("source"))


@query("SELECT conv_id, turn, length(text) > 160 AS cut, CASE WHEN length(text) > 160 THEN text[:159] || '…' ELSE text END AS line FROM conversations")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.length("text") > 160).alias("cut"), scalars.ellipsis(F.col("text")).alias("line"))


_HOURS = {  # text, and what it is read as (null: not at all)
    0: ("9:00 AM – 5:00 PM", "09:00-17:00"), 1: ("Closed", "closed"), 2: ("Open 24 hours", "open_24h"), 3: ("24 horas", "open_24h"), 4: ("Fechada", "closed"), 5: ("08:00-12:00, 13:00 — 17:30", "08:00-12:00, 13:00-17:30"),
    6: ("12:00 AM – 11:59 PM", "00:00-23:59"), 7: ("5 p.m. - 2 a.m.", "17:00-02:00"), 8: ("12:00 PM – 12:30 PM", "12:00-12:30"), 9: ("por agendamento", None), 10: ("25:00-26:00", None), 11: ("13:00 PM – 2:00 PM", None), 12: ("9:60 – 10:00", None),
}
_DAY_NAMES = [["Monday", "segunda-feira"], ["Tuesday", "terça-feira"], ["Wednesday", "Quarta"], ["Thursday", "QUINTA FEIRA"], ["Friday", "sexta"], ["Saturday", "sábado"], ["Sunday", "domingo"]]
_CASE = "CASE {x} " + " ".join(f"WHEN {k} THEN {'NULL' if v is None else repr(v)}" for k, (_, v) in _HOURS.items()) + " END"


@query(
    f"""WITH d AS (SELECT o_orderkey, g, i, {_CASE.format(x='h')} AS h FROM (SELECT o_orderkey, g, i, CASE WHEN (g + i) % 7 < 4 THEN g % 13 WHEN (g + i) % 7 = 4 THEN (g * 3) % 9 ELSE (g * 5) % 9 END AS h FROM (SELECT o_orderkey, CAST(o_orderkey % 97 AS INT) AS g FROM orders), (SELECT unnest(range(0, 7)) AS i))),
r AS (SELECT *, sum(c) OVER (PARTITION BY o_orderkey ORDER BY i) AS run FROM (SELECT *, CASE WHEN h IS NOT DISTINCT FROM lag(h) OVER (PARTITION BY o_orderkey ORDER BY i) AND i > 0 THEN 0 ELSE 1 END AS c FROM d)),
k AS (SELECT o_orderkey, min(i) AS a, max(i) AS b, first(h) AS h FROM r GROUP BY o_orderkey, run),
n AS (SELECT *, ['mon', 'tue', 'wed', 'thu', 'fri', 'sat', 'sun'] AS days FROM k),
m AS (SELECT o_orderkey, string_agg((CASE WHEN a = 0 AND b = 6 THEN 'daily' WHEN a = b THEN days[a + 1] ELSE days[a + 1] || '_' || days[b + 1] END) || '=' || h, ';' ORDER BY a) AS hours, count(*) = count(h) AS sound FROM n GROUP BY 1)
SELECT o_orderkey, CASE WHEN sound AND o_orderkey % 11 <> 0 THEN hours END AS hours FROM m"""
)
def opening_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of varied days in two languages, some unreadable; every eleventh lacks a day."""
    g = (F.col("o_orderkey") % 97).cast("int")
    texts = F.array(*(F.lit(t) for t, _ in _HOURS.values()))
    kind = lambda i: F.when((g + i) % 7 < 4, g % 13).when((g + i) % 7 == 4, (g * 3) % 9).otherwise((g * 5) % 9)
    lines = [F.concat(F.when(g % 2 == 0, names[0]).otherwise(names[1]), F.lit(": "), F.get(texts, kind(i))) for i, names in enumerate(_DAY_NAMES)]
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.array(*lines[:6])).otherwise(F.array(*reversed(lines))).alias("lines"))
    m = hours.hours_map(F.col("lines"))
    return d.select("o_orderkey", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("hours"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))::INTEGER AS n_links, regexp_extract(html, 'track\\((\\d+)\\)', 1)::BIGINT AS island FROM pages")
def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, links and the value embedded in the page's script."""
    return page_source.cards(table(spark, sf_dir, "pages"))


@query("SELECT page_id, list_aggregate(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '>([^<>]+)<', 1), 'string_agg', ' > ') AS breadcrumb FROM pages")
def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.breadcrumb(table(spark, sf_dir, "pages"))


@query("SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, split_part(split_part(url, '://', 2), '/', 2) AS lang FROM pages")
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.split_part("url", F.lit("://"), F.lit(2))
    return table(spark, sf_dir, "pages").select("page_id", F.split_part(rest, F.lit("/"), F.lit(1)).alias("host"), F.split_part(rest, F.lit("/"), F.lit(2)).alias("lang"))
