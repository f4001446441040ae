"""Weekly opening hours: seven lines such as `Monday: 9:00 AM – 5:00 PM` to a compact map, in column functions.

All or nothing: a line that cannot be read, or anything but seven distinct days, gives null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from varzea.functions.scalars import collapse, fold

# Names of the days, words for closed and for open all day.
DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
NAMES = [["monday", "segunda"], ["tuesday", "terca"], ["wednesday", "quarta"], ["thursday", "quinta"], ["friday", "sexta"], ["saturday", "sabado"], ["sunday", "domingo"]]
CLOSED, ALL_DAY = ["closed", "fechado", "fechada"], ["open 24 hours", "24 hours", "aberto 24 horas", "24 horas"]
OPEN = "open_24h"


def _day(line: Column) -> Column:
    label = F.regexp_replace(F.lower(fold(F.trim(F.split_part(line, F.lit(":"), F.lit(1))))), "[- ]feira", "")
    return F.try_element_at(F.create_map(*(y for i, names in enumerate(NAMES) for n in names for y in (F.lit(n), F.lit(i)))), label)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once: a lambda's variable, where a column's expression would be repeated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _clock(t: Column) -> Column:
    """`5:00 PM`, `5 p.m.` or `17:00` as minutes of the day, null if it is no time. Hour, minute and half of the day are taken
    apart as fields: letters are the half, digits before and after the colon the numbers."""

    def read(f: Column) -> Column:
        half, numbers = f["half"], f["numbers"]
        hour, minute = F.get(numbers, F.lit(0)), F.coalesce(F.get(numbers, F.lit(1)), F.when(half != "", "00"))
        sound = (F.size(numbers) <= 2) & hour.rlike("^[0-9]{1,2}$") & minute.rlike("^[0-5][0-9]$")
        h, m = hour.try_cast("int"), minute.try_cast("int")
        on_24 = F.when((half == "") & (h < 24), h)
        on_12 = F.when(half.isin("am", "pm") & h.between(1, 12), h % 12 + F.when(half == "pm", 12).otherwise(0))
        return F.when(sound, F.coalesce(on_24, on_12) * 60 + m)

    text = F.lower(F.translate(t, " .\u00a0\u202f\t", ""))
    fields = lambda x: F.struct(F.regexp_extract(x, "[a-z].*$", 0).alias("half"), F.split(F.regexp_replace(x, "[a-z].*$", ""), ":").alias("numbers"))
    return let(let(text, fields), read)


def _hours(line: Column) -> Column:
    """What follows the day's colon: closed, open all day, or spans of time in the order given."""
    said = F.substr(line, F.instr(line, F.lit(":")) + 1)
    show = lambda t: F.concat(F.lpad(F.floor(t / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((t % 60).cast("string"), 2, "0"))

    def span(part: Column) -> Column:
        ends = F.transform(F.split(F.translate(part, "–—", "--"), "-"), _clock)
        return let(ends, lambda e: F.when(F.size(e) == 2, F.concat(show(F.get(e, F.lit(0))), F.lit("-"), show(F.get(e, F.lit(1))))))

    word = lambda w: F.when(w.isin(CLOSED), "closed").when(w.isin(ALL_DAY), OPEN)
    spans = let(F.transform(F.split(said, ","), span), lambda x: F.when(~F.exists(x, lambda e: e.isNull()), F.array_join(x, ", ")))
    return F.coalesce(let(collapse(F.lower(fold(said))), word), spans)


def _runs(week: Column) -> Column:
    """Seven days' hours as (first day, last day, hours) of runs of equal days: a day begins a run unless it is like the one before."""
    begins = F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: (i == 0) | (F.get(week, i) != F.get(week, i - 1)))
    return let(begins, lambda b: F.transform(b, lambda i, k: F.struct(i.alias("a"), (F.coalesce(F.get(b, k + 1), F.lit(7)) - 1).alias("b"), F.get(week, i).alias("h"))))


def _compact(parsed: Column) -> Column:
    week = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.element_at(F.filter(parsed, lambda p: p["d"] == i), -1)["h"])
    keys = F.array(*map(F.lit, DAYS))
    name = lambda r: F.when((r["a"] == 0) & (r["b"] == 6), "daily").when(r["a"] == r["b"], F.get(keys, r["a"])).otherwise(F.concat(F.get(keys, r["a"]), F.lit("_"), F.get(keys, r["b"])))
    made = let(week, lambda w: F.map_from_entries(F.transform(_runs(w), lambda r: F.struct(name(r).alias("key"), r["h"].alias("value")))))
    bad = F.exists(parsed, lambda p: p["d"].isNull() | p["h"].isNull())
    return F.when(~bad & (F.size(F.array_distinct(F.transform(parsed, lambda p: p["d"]))) == 7), made)


def hours_map(lines: Column) -> Column:
    """array<string> to map<string,string>: equal days `daily`, runs of equal days `mon_fri`, single days by name."""
    parsed = F.transform(lines, lambda s: F.struct(F.when(s.contains(":"), _day(s)).alias("d"), _hours(s).alias("h")))
    return let(parsed, _compact)
