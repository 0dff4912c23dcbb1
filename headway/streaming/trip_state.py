"""Keyed state of trips (S2): the observed rows of running trips, so that a batch doesn't re-read the poll log.

A trip's best offset depends on all of its rows.  The state of a trip holds its number of timetable
rows (the initial state of the stream), how many rows were observed, and these rows.  A batch gets

* its new rows (``kind`` NEW), for the poll log;
* all rows so far of every trip that it touches (``kind`` HELD), from the state;
* a row for every trip that it touches whose rows aren't held (``kind`` LOGGED): they are in the poll log.

Trips are kept in groups by a hash of their id, a group under one key: a call of a worker to the state
store costs as much as dozens of rows, so a batch pays a few calls per group, not per trip.  A batch reads
the groups that it touches; ``trip_groups`` sets how many trips a group holds.

What a trip holds is bounded: a trip with more observed rows than timetable rows never aligns again, as
both only grow, so its rows are dropped; trips with a timetable of more than ``held_rows`` are left to
the poll log from the start; trips that the timetable doesn't list hold nothing.  A timer ends a trip
without news for ``idle_seconds`` and frees its rows; if a row comes after that, the trip's rows are read
from the poll log.  So late rows are never lost, and results don't depend on when a trip ends.

Rows without a trip id give nothing: they can never join a trip and aren't logged by trip.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from headway import schemas

NEW, HELD, LOGGED = "new", "held", "logged"
#: Longest timetable of a trip whose observed rows are held in state.
HELD_ROWS = 2_000
#: Groups of trips; fixed for the life of a stream.
TRIP_GROUPS = 4_096
#: Timetable rows of a group, about, where the number of groups is chosen by the timetable.
GROUP_STOPS = 1_000
#: Rows that go into the state at a time.
CHUNK_ROWS = 500
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_ROW = Row(*schemas.RT_TRIP_UPDATES.names, "kind")
OBSERVED = T.StructType([f for f in schemas.RT_TRIP_UPDATES if f.name != "trip_id"])
HELD_ROW = T.StructType([T.StructField("trip_id", T.StringType()), *OBSERVED])
OUTPUT = T.StructType([*schemas.RT_TRIP_UPDATES.fields, T.StructField("kind", T.StringType())])
FACT = T.StructType([
    T.StructField("trip_id", T.StringType()), T.StructField("stops", T.LongType()), T.StructField("observed", T.LongType()), T.StructField("ends_at", T.LongType()), T.StructField("held", T.BooleanType()),
])
#: What is known of a group's trips, and when its timer goes off (0: none is set).
FACTS = T.StructType([T.StructField("trips", T.ArrayType(FACT)), T.StructField("wakes_at", T.LongType())])


class TripProcessor(StatefulProcessor):
    def __init__(self, idle_seconds: float | None, held_rows: int):
        self.idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)
        self.held_rows = held_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.facts = handle.getValueState("facts", FACTS)
        self.rows = handle.getListState("rows", HELD_ROW)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.facts.update(([(t["trip_id"], t["stops"], 0, 0, t["stops"] <= self.held_rows) for t in initialState["trips"]], 0))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, wakes_at = self.facts.get() or ([], 0)
        facts = {f[0]: list(f[1:]) for f in known or []}  # stops, observed, ends_at, held
        stored = [tuple(r) for r in self.rows.get()] if any(observed for _, observed, _, _ in facts.values()) else []
        touched: dict[str, list[tuple]] = {}  # the new rows of a trip, as long as it can align
        while chunk := list(islice(rows, CHUNK_ROWS)):
            for r in chunk:
                trip = r["trip_id"]
                own, fact = touched.setdefault(trip, []), facts.get(trip)
                if fact is not None:
                    fact[1] += 1
                    if fact[3] and fact[1] <= fact[0]:
                        own.append(tuple(r[c] for c in HELD_ROW.names))
                    else:
                        own.clear()
                yield _ROW(*(r[c] for c in schemas.RT_TRIP_UPDATES.names), NEW)
        holds = {trip for trip, (stops, observed, _, held) in facts.items() if held and observed <= stops}
        fresh = [r for trip, own in touched.items() if trip in holds for r in own]
        kept = [r for r in stored if r[0] in holds]
        for r in kept:
            if r[0] in touched:
                yield _ROW(*r, HELD)
        for r in fresh:
            yield _ROW(*r, HELD)
        for trip in touched:
            if trip in facts and not facts[trip][3] and facts[trip][1] <= facts[trip][0]:
                yield _ROW(trip, *[None] * len(OBSERVED), LOGGED)
        if len(kept) < len(stored):  # some trips never align again
            self.keep(kept + fresh)
        else:
            self.append(fresh)
        if self.idle_ms is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            for trip in touched:
                if trip in holds:
                    facts[trip][2] = now + self.idle_ms
            wakes_at = self.wake(facts, wakes_at)
        self.facts.update(([(trip, *fact) for trip, fact in facts.items()], wakes_at))

    def append(self, rows: list[tuple]) -> None:
        for at in range(0, len(rows), CHUNK_ROWS):
            self.rows.appendList(rows[at : at + CHUNK_ROWS])

    def keep(self, rows: list[tuple]) -> None:
        self.rows.clear()
        self.append(rows)

    def wake(self, facts: dict[str, list], wakes_at: int) -> int:
        """Set the group's timer to the end of the first trip that holds rows; when that is."""
        ends = min((ends_at for stops, observed, ends_at, held in facts.values() if ends_at and held and observed <= stops), default=0)
        if ends != wakes_at:
            if wakes_at:
                self.handle.deleteTimer(wakes_at)
            if ends:
                self.handle.registerTimer(ends)
        return ends

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known, wakes_at = self.facts.get()
        now = expiredTimerInfo.getExpiryTimeInMs()
        if now == wakes_at:
            facts = {f[0]: list(f[1:]) for f in known}
            ended = {trip for trip, (_, _, ends_at, held) in facts.items() if held and ends_at and ends_at <= now}
            self.keep([tuple(r) for r in self.rows.get() if r[0] not in ended])
            for trip in ended:
                facts[trip][2:] = [0, False]
            self.facts.update(([(trip, *fact) for trip, fact in facts.items()], self.wake(facts, 0)))
        return iter(())


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started inside; the caller's setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def trip_groups(stop_times: DataFrame) -> int:
    """Number of groups by the size of the timetable, so that a group stays as large as the timetable grows."""
    return max(1, -(-stop_times.count() // GROUP_STOPS))


def trip_rows(polls: DataFrame, stop_times: DataFrame, idle_seconds: float | None = None, held_rows: int = HELD_ROWS, groups: int = TRIP_GROUPS) -> DataFrame:
    """Streaming frame OUTPUT of the polled rows: new ones, and all of each touched trip.

    ``stop_times`` is read when the stream begins anew.  Without ``idle_seconds`` trips never end.
    ``groups`` must stay the same for the life of a stream.  Start the query inside ``state_store``.
    """
    group = F.pmod(F.xxhash64("trip_id"), F.lit(groups)).alias("trip_group")
    stops = stop_times.where(F.col("trip_id").isNotNull()).groupBy("trip_id").agg(F.count(F.lit(1)).alias("stops"))
    listed = stops.groupBy(group).agg(F.collect_list(F.struct("trip_id", "stops")).alias("trips"))
    known = polls.where(F.col("trip_id").isNotNull()).select(*schemas.RT_TRIP_UPDATES.names, group)
    processor = TripProcessor(idle_seconds, held_rows)
    mode = "None" if idle_seconds is None else "ProcessingTime"
    return known.groupBy("trip_group").transformWithState(processor, OUTPUT, "Append", mode, initialState=listed.groupBy("trip_group"))
