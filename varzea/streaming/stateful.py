"""Stateful pieces: a guarded state machine, counters with a floor, rate limits; for streams and for batches alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.operators.rules import EDGES
from varzea.operators.scans import running_sums

_NEXT = {(a, b) for a, b in EDGES}


def advance(state: str | None, moves: Iterable[str]) -> tuple[str | None, int, int]:
    """Fold moves: an edge of the machine advances, anything else is a no-op. Returns state, moves made, moves ignored."""
    made = ignored = 0
    for m in moves:
        if (state, m) in _NEXT:
            state, made = m, made + 1
        else:
            ignored += 1
    return state, made, ignored


def fold_sorted(rows: DataFrame, key: str, order: list[str], schema: str, begin: Callable, step: Callable, end: Callable) -> DataFrame:
    """Fold each key's rows in order. Spark sorts the rows by key and order; a task passes over them in Arrow batches and holds
    one state only, however many rows a key has. `begin()` makes a state, `step(state, rows)` folds rows of one key,
    `end(state)` makes the output tuple after the key."""

    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, started = None, None, False
        for pdf in batches:
            done = []
            for k, part in pdf.groupby(key, sort=False, dropna=False):
                if not started or k != now:
                    if started:
                        done.append((now, *end(state)))
                    now, state, started = k, begin(), True
                state = step(state, part)
            if done:
                yield pd.DataFrame(done, columns=[key, *names])
        if started:
            yield pd.DataFrame([(now, *end(state))], columns=[key, *names])

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {schema}")


def machine_batch(moves: DataFrame, key: str, order: list[str], move: str) -> DataFrame:
    """(key, state, made, ignored) from a table of moves."""

    def step(s, part):
        state, made, ignored = advance(s[0], part[move])
        return state, s[1] + made, s[2] + ignored

    return fold_sorted(moves.select(key, *order, move), key, order, "state string, made long, ignored long", lambda: (None, 0, 0), step, lambda s: s)


def machine_stream(moves: DataFrame, key: str, order: list[str], move: str) -> DataFrame:
    """The same fold over a stream, the state kept per key; each micro-batch is folded in order."""

    def fold(group, batches, state):
        current, made, ignored = state.get if state.exists else (None, 0, 0)
        rows = pd.concat(list(batches)).sort_values(order)
        current, m, i = advance(current, rows[move])
        state.update((current, made + m, ignored + i))
        yield pd.DataFrame({key: [group[0]], "state": [current], "made": [made + m], "ignored": [ignored + i]})

    out = f"{key} {dict(moves.dtypes)[key]}, state string, made long, ignored long"
    return moves.groupBy(key).applyInPandasWithState(fold, out, "state string, made long, ignored long", "update", "NoTimeout")


def floored_counters(rows: DataFrame, key: str, at: str, order: list[str], delta: str) -> DataFrame:
    """Running counters that refunds cannot take below zero, per key (a day). The floored counter is the sum less its least
    prefix sum below zero, and prefix sums are added up by stretches, so that no key is one task."""
    d = rows.select(key, at, *order, F.col(delta).alias("_d"))
    least = running_sums(d, [key], [at, *order], {"_p": F.col("_d")}, inclusive=True).groupBy(key).agg(F.sum("_d").alias("_sum"), F.min("_p").alias("_least"))
    return least.select(key, (F.col("_sum") - F.least(F.lit(0), F.col("_least"))).alias("total"))


def window_limit(state: tuple[float, int, int, int], times: Iterable[float], seconds: int, most: int) -> tuple[float, int, int, int]:
    """(begin, hits, admitted, refused) after further hits: a window starts at the first hit after the last window's end."""
    begin, n, ok, no = state
    for t in times:
        begin, n = (t, 1) if t - begin >= seconds else (begin, n + 1)
        ok, no = (ok + 1, no) if n <= most else (ok, no + 1)
    return begin, n, ok, no


def fixed_window_limit(rows: DataFrame, key: str, at: str, seconds: int = 60, most: int = 10) -> DataFrame:
    """(key, admitted, refused)."""
    timed = rows.select(key, F.col(at).cast("double").alias("_at"))
    return fold_sorted(timed, key, ["_at"], "admitted long, refused long", lambda: (float("-inf"), 0, 0, 0), lambda s, part: window_limit(s, part["_at"], seconds, most), lambda s: (s[2], s[3]))


def window_limit_stream(rows: DataFrame, key: str, at: str, seconds: int = 60, most: int = 10) -> DataFrame:
    """The same over a stream; the state of a key that has been silent for a day goes."""

    def fold(group, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        s = window_limit(state.get if state.exists else (float("-inf"), 0, 0, 0), sorted(float(t) for b in batches for t in b["_at"]), seconds, most)
        state.update(s)
        state.setTimeoutDuration(86_400_000)
        yield pd.DataFrame({key: [group[0]], "admitted": [s[2]], "refused": [s[3]]})

    timed = rows.select(key, F.col(at).cast("double").alias("_at"))
    out = f"{key} {dict(rows.dtypes)[key]}, admitted long, refused long"
    return timed.groupBy(key).applyInPandasWithState(fold, out, "begin double, n long, ok long, no long", "update", "ProcessingTimeTimeout")
