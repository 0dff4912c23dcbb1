"""The offset search by bounds: same winners as scoring every offset, and far fewer rows."""

import random

from pyspark.sql import functions as F

from headway import schemas
from headway.operators import align as A
from headway.operators.offset_search import block_bounds, offset_ranges
from tests.test_align import BASE, frames, hms, observed, timetable


def random_trips(seed, trips=40):
    """Trips of up to 90 stops: noise, repeated times, unpadded hours, missing times and arrivals, days apart."""
    rng = random.Random(seed)
    st, rt, names = [], [], []
    for k in range(trips):
        trip, n = f"t{k}", rng.randint(1, 90)
        at, stops = rng.randint(4 * 3600, 11 * 3600), []
        for i in range(n):
            at += rng.choice([0, 0, 60, 300, 1234])
            text = hms(at) if rng.random() < 0.8 else hms(at).lstrip("0") or hms(at)
            stops.append((trip, f"S{i}", None if k % 5 == 0 and rng.random() < 0.2 else text, None, i + 1))
        m = rng.randint(1, n + 1)
        skip = rng.randint(0, max(0, n - m))
        begin = rng.randint(4 * 3600, 12 * 3600)
        for i in range(m):
            t = BASE + rng.choice([0, 0, 0, 86400]) + begin + (i + skip) * 300 + rng.randint(-900, 900)
            null = k % 7 == 0 or (k % 3 == 0 and rng.random() < 0.3)
            rt.append((trip, None, f"R{i}", 0, None if null else t, None, "p", "p"))
        st += stops
        names.append(trip)
    return st, rt, names


def parts(spark, st_rows, rt_rows, names):
    st, rt, tr, _ = frames(spark, st_rows, rt_rows, names)
    return A.rt_sequence(rt).cache(), A.static_sequence(st).cache(), A.offset_candidates(rt, st, tr).cache()


def test_search_equals_scoring_every_offset(spark):
    for seed in (1, 2, 3):
        rs, ss, cand = parts(spark, *random_trips(seed))
        want = {tuple(r) for r in A.best_offsets(A.score_offsets(rs, ss, cand)).collect()}
        for whole in (1, 8, 1000):
            assert {tuple(r) for r in A.search_best_offsets(rs, ss, cand, whole=whole).collect()} == want
        assert len(want) > 20


def test_bounds_hold_for_every_offset(spark):
    rs, ss, cand = parts(spark, *random_trips(4))
    long = cand.select("trip_id", (F.col("static_count") - F.col("rt_count")).cast("int").alias("_last"))
    bounds = block_bounds(rs, ss, long)
    scores = A.score_offsets(rs, ss, cand)
    inside = scores.join(bounds, (scores.trip_id == bounds.trip_id) & (F.floor(F.col("seq_offset") / F.col("width")) == F.col("block")))
    assert inside.count() > 300
    outside = (F.col("median_abs_error_min") < F.col("lower")) | (F.col("median_abs_error_min") > F.col("upper"))
    assert inside.where(outside).count() == 0


def test_long_trips_give_far_fewer_candidate_rows(spark):
    st_rows = [r for k in range(4) for r in timetable(f"l{k}", 5 * 3600, 220, gap=240)]
    rt_rows = [r for k in range(4) for r in observed(f"l{k}", 5 * 3600, 20 + 30 * k, 20, delay_s=100, gap=240)]
    st_rows += timetable("short", 8 * 3600, 12)
    rt_rows += observed("short", 8 * 3600, 4, 5)
    rs, ss, cand = parts(spark, st_rows, rt_rows, ["l0", "l1", "l2", "l3", "short"])
    sizes = cand.where("trip_id != 'short'").agg(F.sum(F.col("rt_count") * (F.col("static_count") - F.col("rt_count") + 1))).first()[0]
    ranges = offset_ranges(rs, ss, cand).cache()
    scored = ranges.where("trip_id != 'short'").join(cand, "trip_id")
    scored = scored.agg(F.sum(F.col("rt_count") * (F.col("last_offset") - F.col("first_offset") + 1))).first()[0]
    blocks = 4 * 20 * 26  # 201 offsets in blocks of 8: 26 bounds a row
    assert sizes == 4 * 20 * 201 and scored + blocks < sizes / 3
    assert [tuple(r) for r in ranges.where("trip_id = 'short'").collect()] == [("short", 0, 7)]
    best = {r.trip_id: r.best_offset for r in A.search_best_offsets(rs, ss, cand).collect()}
    assert best == {"l0": 20, "l1": 50, "l2": 80, "l3": 110, "short": 4}


def test_trip_without_arrivals_takes_offset_zero(spark):
    rt_rows = [("t", None, f"R{i}", 0, None, None, "p", "p") for i in range(2)]
    rs, ss, cand = parts(spark, timetable("t", 8 * 3600, 60), rt_rows, ["t"])
    assert [tuple(r)[:4] for r in offset_ranges(rs, ss, cand).collect()] == [("t", 0, 0)]
    row = A.search_best_offsets(rs, ss, cand).collect()[0]
    assert (row.best_offset, row.aligned_rows, row.median_abs_error_min) == (0, 2, None)


def test_empty_tables(spark):
    st, rt = spark.createDataFrame([], schemas.STOP_TIMES), spark.createDataFrame([], schemas.RT_TRIP_UPDATES)
    rs, ss = A.rt_sequence(rt), A.static_sequence(st)
    assert A.search_best_offsets(rs, ss, A.offset_candidates(rt, st), whole=1).count() == 0


def test_search_of_short_trips_runs_without_shuffle(spark):
    from headway.sources.raw_layer import raw_transit
    from tests.conftest import SMOKE
    from tests.test_plans import exchanges

    t = raw_transit(spark, SMOKE)
    rs, ss = A.rt_sequence(t.rt_updates), A.static_sequence(t.stop_times)
    assert exchanges(A.search_best_offsets(rs, ss, A.offset_candidates(t.rt_updates, t.stop_times, t.trips))) == []
