"""The stage machine over a stream: event time, late moves put in order, and an audit row for every move.

A move waits in its key's state until the watermark has passed it, so moves that arrive late but within the watermark are
folded in order of time and id, as a table of them would be. An event-time timer for the first move that waits wakes the key; one
at a time, since a timer for each move costs a call each. A move counts if the state is
the one that it expects and the step is an edge of the machine; else it is recorded as refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from varzea.operators.rules import EDGES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AUDIT = "at timestamp, id long, before string, after string, applied boolean"


def step(state: str | None, expected: str | None, move: str, edges=frozenset(EDGES)) -> tuple[str | None, bool]:
    """The state after a move, and whether the move was made."""
    made = state == expected and (state, move) in edges
    return (move if made else state), made


class Machine(StatefulProcessor):
    """Per key the state reached and the moves that the watermark has not passed yet."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reached = handle.getValueState("reached", "state string")
        self.armed = handle.getValueState("armed", "ms long")
        self.waiting = handle.getListState("waiting", "ms long, id long, expected string, move string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        ms = (new["at"].astype("datetime64[us]").astype("int64") // 1000).tolist()
        plain = lambda c: [None if pd.isna(x) else x for x in new[c]]
        self.waiting.appendList(list(zip(ms, new["id"].tolist(), plain("expected"), plain("move"))))
        first, armed = min(ms), self.armed.get()[0] if self.armed.exists() else None
        if armed is None or first < armed:
            self.arm(first)
        return iter(())

    def arm(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.armed.update((ms,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All moves up to the watermark are folded at once; the first of the later ones gets the next timer."""
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        moves = list(self.waiting.get()) if self.waiting.exists() else []
        due = sorted((m for m in moves if m[0] <= passed), key=lambda m: (m[0], m[1]))
        if not due:
            return
        later = [m for m in moves if m[0] > passed]
        if later:
            self.waiting.put(later)
            self.arm(min(m[0] for m in later))
        else:
            self.waiting.clear()
            self.armed.clear()
        state, out = (self.reached.get()[0] if self.reached.exists() else None), []
        for ms, number, expected, move in due:
            before, (state, made) = state, step(state, expected, move)
            out.append((*key, pd.Timestamp(ms, unit="ms"), number, before, move, made))
        self.reached.update((state,))
        yield pd.DataFrame(out, columns=["key", "at", "id", "before", "after", "applied"])

    def close(self) -> None:
        pass


def audit_stream(moves: DataFrame, delay: str) -> DataFrame:
    """A row for each move of a stream (key, at, id, expected, move), once the watermark of `delay` has passed it. Moves that come
    later than that are dropped by Spark. The state store has to be RocksDB (`rocksdb`)."""
    kind = dict(moves.dtypes)["key"]
    grouped = moves.withWatermark("at", delay).groupBy("key")
    return grouped.transformWithStateInPandas(Machine(), f"key {kind}, {AUDIT}", "Append", "EventTime")


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB, which stateful processors need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def outcome(audit: DataFrame) -> DataFrame:
    """(key, state, made, ignored) after all audited moves."""
    order = F.struct("at", "id")
    return audit.groupBy("key").agg(F.max_by("after", F.when(F.col("applied"), order)).alias("state"), F.count_if("applied").alias("made"), F.count_if(~F.col("applied")).alias("ignored"))
