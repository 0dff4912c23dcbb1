"""Alignment on hand-made trips (FIXTURES §4) and its properties."""


import pandas as pd
from pyspark.sql import functions as F

from headway import schemas
from headway.operators import align as A
from headway.operators import delay as DL

BASE = 1704096000  # 2024-01-01 00:00 America/Los_Angeles


def hms(sec):
    return f"{sec // 3600:02d}:{sec % 3600 // 60:02d}:{sec % 60:02d}"


def timetable(trip, start, n, gap=300):
    return [(trip, f"S{i}", hms(start + i * gap), hms(start + i * gap + 30), i + 1) for i in range(n)]


def observed(trip, start, skip, m, delay_s=0, gap=300, day=0, poll="2024-01-01T00:00:00+00:00"):
    out = []
    for i in range(skip, skip + m):
        t = BASE + day * 86400 + start + i * gap + delay_s
        out.append((trip, None, f"R{i}", 0, t, t + 30, poll, poll))
    return out


def frames(spark, st_rows, rt_rows, trips):
    st = spark.createDataFrame(st_rows, schemas.STOP_TIMES)
    rt = spark.createDataFrame(rt_rows, schemas.RT_TRIP_UPDATES)
    tr = spark.createDataFrame([(t, "R-" + t, 0, "svc") for t in trips], schemas.TRIPS)
    stops = spark.createDataFrame([(f"S{i}", f"C{i}", f"Stop {i}") for i in range(40)], schemas.STOPS)
    return st, rt, tr, stops


def best(spark, st, rt, tr, scorer="median_minutes"):
    rs, ss = A.rt_sequence(rt), A.static_sequence(st)
    cand = A.offset_candidates(rt, st, tr if scorer != "circular_seconds" else None)
    return {r.trip_id: r for r in A.best_offsets(A.score_offsets(rs, ss, cand, scorer), scorer).collect()}


def test_zero_noise_tail_recovers_true_offset(spark):
    st_rows = timetable("a", 8 * 3600, 12) + timetable("b", 9 * 3600, 10) + timetable("c", 10 * 3600, 6)
    rt_rows = observed("a", 8 * 3600, 4, 5) + observed("b", 9 * 3600, 0, 10) + observed("c", 10 * 3600, 2, 3, delay_s=120)
    st, rt, tr, _ = frames(spark, st_rows, rt_rows, ["a", "b", "c"])
    b = best(spark, st, rt, tr)
    assert (b["a"].best_offset, b["b"].best_offset, b["c"].best_offset) == (4, 0, 2)
    assert b["a"].median_abs_error_min == 0.0 and b["c"].median_abs_error_min == 2.0


def test_dropped_trips_and_null_arrivals(spark):
    st_rows = timetable("long_rt", 8 * 3600, 3) + timetable("no_trip", 9 * 3600, 5) + timetable("nulls", 10 * 3600, 4)
    rt_rows = (observed("long_rt", 8 * 3600, 0, 5) + observed("no_trip", 9 * 3600, 1, 3)
               + [("nulls", None, f"R{i}", 0, None, None, "p", "p") for i in range(2)])
    st, rt, tr, stops = frames(spark, st_rows, rt_rows, ["long_rt", "nulls"])
    b = best(spark, st, rt, tr)
    assert set(b) == {"nulls"}  # more observed rows than stops: dropped; not in trips: dropped
    assert b["nulls"].best_offset == 0 and b["nulls"].median_abs_error_min is None
    assert b["nulls"].aligned_rows == 2
    circ = best(spark, st, rt, tr, "circular_seconds")
    assert set(circ) == {"no_trip", "nulls"}  # the circular variant skips the trips filter
    delay = DL.delay_layer(A.align_best_offset(rt, st, tr, stops))
    assert delay.where(F.col("trip_id") == "nulls").count() == 0


def test_equal_scores_pick_lowest_offset(spark):
    # Three stops at the same time: every offset scores the same.
    st_rows = [("t", f"S{i}", "08:00:00", "08:00:30", i + 1) for i in range(3)]
    rt_rows = observed("t", 8 * 3600, 0, 1)
    st, rt, tr, _ = frames(spark, st_rows, rt_rows, ["t"])
    assert best(spark, st, rt, tr)["t"].best_offset == 0


def test_string_order_of_unpadded_hours(spark):
    st_rows = [("t", "S1", "9:59:00", "9:59:30", 1), ("t", "S2", "10:01:00", "10:01:30", 2)]
    st = spark.createDataFrame(st_rows, schemas.STOP_TIMES)
    by_text = {r.stop_id: r.static_seq for r in A.static_sequence(st).collect()}
    by_secs = {r.stop_id: r.static_seq for r in A.static_sequence(st, order_by="seconds").collect()}
    assert by_text == {"S2": 1, "S1": 2} and by_secs == {"S1": 1, "S2": 2}


def test_day_boundary_published_and_wrapped(spark):
    st_rows = [("t", "S0", "24:30:00", "24:30:30", 1)]
    rt_rows = [("t", None, "R0", 0, BASE + 86400 + 31 * 60, None, "p", "p")]  # 00:31 next day
    st, rt, tr, stops = frames(spark, st_rows, rt_rows, ["t"])
    aligned = A.align_best_offset(rt, st, tr, stops)
    assert DL.delay_layer(aligned).collect()[0].delay_minutes == -1439
    assert DL.delay_layer(aligned, wrap="nearest_day").collect()[0].delay_minutes == 1


def test_properties_on_provided_tables(spark):
    from headway.sources.fixtures import load_transit

    t = load_transit(spark, "/root/testdata/sf0.001")
    rs, ss = A.rt_sequence(t.rt_updates), A.static_sequence(t.stop_times)
    cand = A.offset_candidates(t.rt_updates, t.stop_times, t.trips)
    scores = A.score_offsets(rs, ss, cand)
    b = A.best_offsets(scores)
    j = b.join(cand, "trip_id")
    assert j.where((F.col("best_offset") < 0) | (F.col("best_offset") > F.col("static_count") - F.col("rt_count"))).count() == 0
    assert j.where(F.col("aligned_rows") != F.col("rt_count")).count() == 0
    # brute force: pandas enumeration of every offset equals the Spark scores
    rp = rs.select("trip_id", "rt_seq", "arrival_time_unix").toPandas()
    sp = ss.select("trip_id", "static_seq", "arrival_time").toPandas()
    cp = cand.toPandas()
    rows = []
    for c in cp.itertuples():
        r = rp[rp.trip_id == c.trip_id]
        s = sp[sp.trip_id == c.trip_id].set_index("static_seq")
        for off in range(0, c.static_count - c.rt_count + 1):
            errs = []
            for x in r.itertuples():
                if pd.isna(x.arrival_time_unix):
                    continue
                local = pd.Timestamp(int(x.arrival_time_unix), unit="s", tz="UTC").tz_convert("America/Los_Angeles").tz_localize(None)
                h, m, sec = map(int, s.loc[x.rt_seq + off, "arrival_time"].split(":"))
                sched = pd.Timestamp(local.date()) + pd.Timedelta(hours=h, minutes=m, seconds=sec)
                errs.append(abs(local.floor("min") - sched.floor("min")) // pd.Timedelta(minutes=1))
            med = float(pd.Series(errs).median()) if errs else None
            rows.append((c.trip_id, off, med))
    want = {(a, b_): m for a, b_, m in rows}
    got = {(r.trip_id, r.seq_offset): r.median_abs_error_min for r in scores.collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-9 for k in want)
