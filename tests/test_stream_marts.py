"""Marts by delta algebra: every state equals the batch marts, only changed buckets are read, batches replay."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators import kpi
from headway.operators import risk as RK
from headway.operators import weather as W
from headway.operators import windows as WN
from headway.operators.align import align_best_offset
from headway.operators.delay import delay_layer
from headway.sources import realtime as RT
from headway.sources.fixtures import TransitTables
from headway.streaming.marts import CELLS, MartStream, merged_cells
from headway.streaming.polls import scratch_folder
from headway.streaming.versions import State, VersionedTables, write_sliced

DAY = 1704096000  # local midnight, 2024-01-01
AS_OF = "2024-01-01 06:00:00"


def transit(spark):
    """Six trips of six stops on three routes, rain in one hour, an event and an alert."""
    hms = lambda trip, i: f"{8 + trip:02d}:{5 * i:02d}:00"
    stop_times = [(f"T{k}", str(i), hms(k, i), hms(k, i), i) for k in range(6) for i in range(1, 7)]
    trips = [(f"T{k}", f"R{k % 3}" if k < 5 else None, 0, "S") for k in range(6)]
    stops = [(str(i), "c", f"stop {i}") for i in range(1, 7)]
    weather = [(f"2024-01-01T{h:02d}:00", 2.0 if h == 9 else 0.0, 10.0 + h, 3.0 * h, 0.0, 0.0, "x") for h in range(7, 13)]
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    events = [("e1", "n", "concert", "r", at(8, 0), at(9, 15), "s"), ("e2", "n", "concert", "r", at(9, 0), at(9, 30), "s"), ("e3", "n", "sports", "r", at(9, 10), at(12, 0), "s")]
    alerts = [("a1", "police", "r", at(10, 0), at(10, 20), "s")]
    frame = spark.createDataFrame
    return TransitTables(
        frame(trips, schemas.TRIPS), frame(stops, schemas.STOPS), frame([("R0",), ("R1",), ("R2",)], "route_id string"),
        frame(stop_times, schemas.STOP_TIMES), frame([], schemas.RT_TRIP_UPDATES), frame(weather, schemas.WEATHER_HOURLY),
        frame(events, schemas.EVENT_WINDOWS), frame(alerts, schemas.SERVICE_ALERT_WINDOWS),
    )


def observed(trip, stop, late, poll, arrival=True):
    unix = DAY + (8 + trip) * 3600 + 300 * stop + 60 * late
    return (f"T{trip}", None, f"S{stop}", stop, unix if arrival else None, unix + 30, poll, poll)


def feed(spark, rows, folder):
    RT.build_feed_documents(spark.createDataFrame(rows, schemas.RT_TRIP_UPDATES)).write.mode("append").json(folder)


def batch_marts(t, rt, snapshot=None):
    delay = delay_layer(align_best_offset(rt, t.stop_times, t.trips, t.stops, snapshot=snapshot))
    route, hours, enriched = kpi.route_performance(delay, rt, t.trips), kpi.route_hour_performance(delay, rt, t.trips), W.enrich_weather(delay, t.weather)
    return {
        "route_performance": route, "stop_performance": kpi.stop_performance(delay, route), "route_hour_performance": hours,
        "weather_impact": W.weather_impact(enriched), "route_weather_impact": W.route_weather_impact(enriched), "hour_day_reliability": RK.hour_day_reliability(delay),
        "event_window_impact": WN.event_window_impact(enriched, t.event_windows), "disruption_association": WN.disruption_association(enriched, t.alert_windows),
        "risk_forecast_next_24h": RK.risk_forecast(hours, t.weather, AS_OF),
    }


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


BATCHES = [
    [observed(k, i, k, "p1") for k in range(5) for i in (1, 2, 3)] + [observed(5, 1, 1, "p1"), observed(0, 4, 2, "p1", arrival=False)],
    [observed(1, i, -3, "p2") for i in (4, 5)] + [observed(9, 1, 0, "p2")],  # later stops of a trip, an unlisted trip
    [observed(2, i, 9, "p3") for i in (1, 2, 3, 4)],  # now more rows than stops: the trip goes from every mart
]


def test_every_batch_equals_the_batch_marts(spark):
    base, t = scratch_folder(spark, "marts"), transit(spark)
    stream = MartStream(spark, f"{base}/s", t, trip_buckets=4, group_buckets=8)
    seen = []
    for at, rows in enumerate(BATCHES):
        feed(spark, rows, f"{base}/feed")
        stream.start(f"{base}/feed").awaitTermination()
        seen += rows
        found, wanted = stream.marts(AS_OF), batch_marts(t, spark.createDataFrame(seen, schemas.RT_TRIP_UPDATES))
        for name, mart in wanted.items():
            if at < len(BATCHES) - 1 and name not in ("stop_performance", "event_window_impact"):
                continue
            assert found[name].columns == mart.columns, name
            assert rows_of(found[name]) == rows_of(mart), name
    assert "T2" not in {r["trip_id"] for r in stream.delay().collect()}
    # versions that no reader can need are gone: only the last two states name folders
    tables = VersionedTables(spark, f"{base}/s/tables")
    last = tables.state()
    named = last.versions("cells") | tables.state(before=last.batch).versions("cells")
    folder = f"{base}/s/tables/cells".removeprefix("file:")
    there = {(int(v[2:]), int(b[7:])) for v in os.listdir(folder) for b in os.listdir(f"{folder}/{v}") if b.startswith("bucket=")}
    assert there == named


def test_a_replayed_or_failed_batch_changes_nothing(spark):
    base, t = scratch_folder(spark, "replay"), transit(spark)
    stream = MartStream(spark, f"{base}/s", t, trip_buckets=4, group_buckets=8, snapshot="latest_poll")
    stream.prepare()
    frames = [spark.createDataFrame(rows, schemas.RT_TRIP_UPDATES) for rows in BATCHES]
    stream.on_batch(frames[0], 0)
    before = rows_of(stream.marts(AS_OF)["stop_performance"])
    commit, stream.tables.commit = stream.tables.commit, lambda new: 1 / 0
    with pytest.raises(ZeroDivisionError):  # all files of the batch are written, but it isn't committed
        stream.on_batch(frames[1], 1)
    assert rows_of(stream.marts(AS_OF)["stop_performance"]) == before
    stream.tables.commit = commit
    for batch in (0, 1, 1):
        stream.on_batch(frames[batch], batch)
        if batch == 0:
            assert rows_of(stream.marts(AS_OF)["stop_performance"]) == before
    wanted = batch_marts(t, frames[0].union(frames[1]), "latest_poll")
    found = stream.marts(AS_OF)
    for name in ("stop_performance", "weather_impact", "route_performance"):
        assert rows_of(found[name]) == rows_of(wanted[name]), name


def test_untouched_groups_are_not_read(spark):
    base, t = scratch_folder(spark, "pruned"), transit(spark)
    stream = MartStream(spark, f"{base}/s", t, trip_buckets=64, group_buckets=64)
    stream.prepare()
    read, original = [], stream.tables.read

    def noted(table, schema, state, only=None):
        df = original(table, schema, state, only)
        read.append((table, {int(f.split("bucket=")[1].split("/")[0]) for f in df.inputFiles()}, only))
        return df

    stream.tables.read = noted
    stream.on_batch(spark.createDataFrame(BATCHES[0], schemas.RT_TRIP_UPDATES), 0)
    read.clear()
    stream.on_batch(spark.createDataFrame([observed(4, 4, 0, "p2")], schemas.RT_TRIP_UPDATES), 1)
    everything = {b for b in stream.tables.state().tables["cells"]}
    for table, files, only in read:
        assert files <= set(only), table
    touched = next(files for table, files, _ in read if table == "cells")
    assert touched and touched < everything  # groups of other routes, hours and stops stay closed
    plan = merged_cells(original("cells", CELLS, stream.tables.state(), sorted(touched)), spark.createDataFrame([], CELLS))._jdf.queryExecution().toString()
    assert f"[{len(touched)} paths]" in plan or plan.count("bucket=") <= len(touched) + 8


def test_hot_buckets_are_split(spark):
    rows = spark.range(10_000).select((F.col("id") % 100 == 0).cast("int").alias("bucket"), F.col("id").alias("v"))
    path = f"{scratch_folder(spark, 'sliced')}/t"
    assert write_sliced(rows, path, file_rows=500) == [0, 1]
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f"), "bucket").count().collect()
    hot = [r["count"] for r in per_file if r["bucket"] == 0]
    assert len(hot) > 5 and max(hot) <= 1000 and sum(hot) == 9_900
    assert sum(r["count"] for r in per_file if r["bucket"] == 1) == 100


def test_states_name_whole_tables(spark):
    tables = VersionedTables(spark, f"{scratch_folder(spark, 'versions')}/t")
    schema = spark.range(1).select("id", F.lit(0).alias("bucket")).schema
    rng, held = random.Random(1), {}
    for batch in range(5):
        touched = rng.sample(range(6), 3)
        state, new = tables.state(before=batch), State(batch)
        filled = [b for b in touched if rng.random() < 0.7]
        tables.write("t", spark.createDataFrame([(batch, b) for b in filled], schema), state, new, touched)
        tables.commit(new)
        held = {b: v for b, v in held.items() if b not in touched} | dict.fromkeys(filled, batch)
        assert {r["bucket"]: r["id"] for r in tables.read("t", schema, tables.state()).collect()} == held


def test_group_rows_are_counted_where_their_trip_lies(spark):
    """Cells equal plain counts, and rows multiplied by their groups are not shuffled by group and trip."""
    from headway.streaming.marts import DELAY, GROUP, delay_cells

    t = transit(spark)
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        trip, stop, at = rng.randrange(6), rng.randrange(1, 4), dt.datetime(2024, 1, 1, rng.randrange(8, 12), rng.randrange(60))
        rows.append((f"T{trip}", f"R{trip % 3}", 0, "S", 0, 1, "S", str(stop), f"stop {stop}", at.date(), at, at, rng.randrange(-2, 4), rng.choice((-1, 1))))
    names = [f.name for f in DELAY if f.name != "bucket"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DELAY if f.name != "bucket") + ", sign int"
    frame = spark.createDataFrame(rows, schema).repartition(5)
    minutes, now, then = {}, set(), set()
    for r in rows:
        r = dict(zip([*names, "sign"], r))
        day = r["actual_arrival_local_ts"]
        for g in (("route_performance", r["route_id"]), ("stop_performance", r["static_stop_id"], r["stop_name"], r["route_id"]), ("route_hour_performance", r["route_id"], str(day.hour))):
            g = (*g, None, None, None, None)[:5]
            minutes[g, r["delay_minutes"]] = minutes.get((g, r["delay_minutes"]), 0) + r["sign"]
            (now if r["sign"] > 0 else then).add((g, r["trip_id"]))
    trips = {}
    for g, trip in now | then:
        trips[g] = trips.get(g, 0) + ((g, trip) in now) - ((g, trip) in then)
    want = {(*g, "delay", m): n for (g, m), n in minutes.items() if n} | {(*g, "trips", None): n for g, n in trips.items() if n}
    found = [sorted(map(tuple, delay_cells(frame, t, by_trip).collect()), key=str) for by_trip in (False, True)]
    assert found[0] == found[1]
    marts = {"route_performance", "stop_performance", "route_hour_performance"}
    got = {r[: len(GROUP) + 2]: r[-1] for r in found[1] if r[0] in marts}
    assert got == want and len(want) > 50
    plan = delay_cells(frame, t, True)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "hashpartitioning(" in line and "trip_id" in line.split("hashpartitioning(")[1]]
    assert moved and all(line.split("hashpartitioning(")[1].startswith("trip_id") for line in moved)


def test_rows_are_summed_before_they_are_multiplied_by_their_groups(spark):
    from headway.streaming.marts import DELAY, delay_cells

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DELAY if f.name != "bucket") + ", sign int"
    plan = delay_cells(spark.createDataFrame([], schema).repartition(2), transit(spark), True)._jdf.queryExecution().optimizedPlan().toString()
    nodes = [line.lstrip(" :+-") for line in plan.splitlines()]
    of_marts = [i for i, node in enumerate(nodes) if node.startswith("Generate explode") and "weather_impact" in node]
    assert len(of_marts) >= 2
    for i in of_marts:
        below = next(node for node in nodes[i + 1 :] if not node.startswith(("Project", "Filter")))
        assert below.startswith("Aggregate"), below
