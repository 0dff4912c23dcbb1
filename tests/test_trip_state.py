"""Keyed state per trip: late polls, restarts and ended trips equal the batch result; the state stays bounded."""

import pytest

from headway import schemas
from headway.streaming import trip_state as TS
from headway.streaming.marts import MartStream
from headway.streaming.polls import scratch_folder
from tests.test_stream_marts import AS_OF, BATCHES, batch_marts, feed, observed, rows_of, transit

#: Rows of earlier runs' trips, long after these could have ended.
LATE = [observed(0, 5, 7, "p0"), observed(3, 6, 1, "p4"), observed(2, 5, 1, "p4"), observed(8, 1, 1, "p4")]


@pytest.mark.parametrize("runs,idle,held", [([BATCHES[0], BATCHES[1] + BATCHES[2], LATE], None, TS.HELD_ROWS), ([sum(BATCHES, []), LATE], 0, TS.HELD_ROWS), ([sum(BATCHES, []), LATE], None, 3)])
def test_restarts_and_late_rows_equal_the_batch(spark, monkeypatch, runs, idle, held):
    base, t = scratch_folder(spark, "state"), transit(spark)
    kinds, read, seen = set(), [], []
    for run, rows in enumerate(runs):  # each run is a new query on the checkpoint of the one before it
        stream = MartStream(spark, f"{base}/s", t, trip_buckets=4, group_buckets=8, keyed_state=True, idle_seconds=idle, held_rows=held)
        staged, whole = stream._staged, stream.observed

        def noted(df, batch_id, name):
            out = staged(df, batch_id, name)
            if name == "taken":
                kinds.update((run, r["kind"]) for r in out.select("kind").distinct().collect())
            return out

        monkeypatch.setattr(stream, "_staged", noted)
        monkeypatch.setattr(stream, "observed", lambda *a: read.append(run) or whole(*a))
        feed(spark, rows, f"{base}/feed")
        query = stream.start(f"{base}/feed")
        assert query.awaitTermination(120), "the stream doesn't end with its input"
        seen += rows
    wanted, found = batch_marts(t, spark.createDataFrame(seen, schemas.RT_TRIP_UPDATES)), stream.marts(AS_OF)
    for name in ("route_performance", "stop_performance", "hour_day_reliability", "weather_impact", "event_window_impact"):
        assert rows_of(found[name]) == rows_of(wanted[name]), name
    assert "T2" not in {r["trip_id"] for r in stream.delay().collect()}
    if idle is None and held > 6:
        assert not read and (2, TS.HELD) in kinds and not any(k == TS.LOGGED for _, k in kinds)
    else:  # ended trips, and those that aren't held, come from the poll log
        assert 1 in read and (1, TS.LOGGED) in kinds
    assert spark.conf.get(TS.PROVIDER, None) != TS.ROCKSDB  # the caller's setting


def test_state_is_bounded_by_the_timetable(spark):
    """What a trip puts out: all rows while it can align, nothing but the new ones when it can't."""
    base, t = scratch_folder(spark, "bounded"), transit(spark)
    got = []
    from headway.streaming.polls import poll_stream

    for rows in ([observed(0, i, 0, "p1") for i in range(1, 5)], [observed(0, i, 0, "p2") for i in range(1, 5)], [observed(0, 1, 0, "p3"), observed(9, 1, 0, "p3")]):
        feed(spark, rows, f"{base}/feed")
        batches = []
        with TS.state_store(spark):
            frame = TS.trip_rows(poll_stream(spark, f"{base}/feed"), t.stop_times)
            query = frame.writeStream.foreachBatch(lambda b, i: batches.append(sorted((r["trip_id"], r["kind"]) for r in b.collect()))).option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        got.append(batches[-1])
    assert got == [[("T0", TS.HELD)] * 4 + [("T0", TS.NEW)] * 4, [("T0", TS.NEW)] * 4, [("T0", TS.NEW), ("T9", TS.NEW)]]


def test_snapshots_have_no_state(spark):
    with pytest.raises(ValueError):
        MartStream(spark, "/nowhere", transit(spark), snapshot="latest_poll", keyed_state=True)


class _Calls:
    """A state of one key that counts the calls to the store."""

    def __init__(self):
        self.value, self.rows, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def getListState(self, name, schema):
        held = _Calls()
        held.get = lambda: self.called(iter(list(self.rows)))
        held.appendList = lambda rows: self.called(self.rows.extend(rows))
        held.clear = lambda: self.called(self.rows.clear())
        return held

    def called(self, result):
        self.calls += 1
        return result

    def get(self):
        return self.called(self.value)

    def update(self, value):
        self.value = self.called(value)


def test_calls_to_the_store_do_not_grow_with_the_trips_of_a_group():
    from pyspark.sql import Row

    def run(trips):
        store, processor = _Calls(), TS.TripProcessor(None, TS.HELD_ROWS)
        processor.init(store)
        processor.handleInitialState((0,), Row(trips=[Row(trip_id=f"T{i}", stops=2) for i in range(trips)]), None)
        out = []
        for poll in ("p1", "p2", "p3"):
            rows = [Row(**dict(zip(schemas.RT_TRIP_UPDATES.names, (f"T{i}", None, "S", 1, 5, 6, poll, poll)))) for i in range(trips)]
            out.append([r["kind"] for r in processor.handleInputRows((0,), iter(rows), None)])
        assert not store.rows  # three rows for a timetable of two: never aligns again
        return store.calls, [(kinds.count(TS.NEW), kinds.count(TS.HELD)) for kinds in out]

    few, many = run(2), run(100)
    assert few[0] == many[0] and many[1] == [(100, 100), (100, 200), (100, 0)]
