"""Plan shape on the bucketed raw layer: the trip-keyed alignment path does not shuffle."""

import re

from headway.operators import align as A
from headway.sources.raw_layer import raw_transit
from tests.conftest import SMOKE


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)


def test_scoring_runs_without_shuffle(spark):
    t = raw_transit(spark, SMOKE)
    rs, ss = A.rt_sequence(t.rt_updates), A.static_sequence(t.stop_times)
    cand = A.offset_candidates(t.rt_updates, t.stop_times, t.trips)
    scores = A.score_offsets(rs, ss, cand)
    best = A.best_offsets(scores)
    assert exchanges(scores) == []
    assert exchanges(best) == []
    assert best.count() > 0


def test_hot_key_tables_are_not_bucketed(spark):
    from headway.sources.raw_layer import bucketable

    df = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1)], "trip_id string, v int")
    spark.conf.set("headway.skew.hotKeyRows", "10")
    try:
        assert bucketable(df, "trip_id") is False
    finally:
        spark.conf.unset("headway.skew.hotKeyRows")
    assert bucketable(df, "trip_id") is True


def test_hot_trips_are_spread_over_the_full_keys(spark):
    """Without bucketing, the placement join and the histogram are exchanged on all their keys."""
    from headway.sources.fixtures import load_transit

    conf = {"headway.skew.hotKeyRows": "5", "spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        t = load_transit(spark, SMOKE)
        rs, ss = A.rt_sequence(t.rt_updates), A.static_sequence(t.stop_times)
        scores = A.score_offsets(rs, ss, A.offset_candidates(t.rt_updates, t.stop_times, t.trips))
        plan = scores._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
    exchanged = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert any(x.startswith("trip_id, static_seq") for x in exchanged)
    assert any(x.startswith("trip_id, seq_offset, ") for x in exchanged)


def test_marts_read_rows_once_and_move_sums_only(spark):
    """A mart over the layer that lies by trip: one scan, and exchanges of (group, minute) sums only."""
    from headway.operators.histogram import delay_kpis
    from headway.plans.catalog import delay_layer

    layer = delay_layer(raw_transit(spark, SMOKE))
    plan = delay_kpis(layer, ["route_id"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan|Scan parquet", plan)) == 1
    exchanged = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert exchanged and all("trip_id" not in x for x in exchanged)


def test_distinct_trips_gather_no_list_per_trip(spark):
    """Trips are counted by their first delay minute in a group; no list per (group, trip) is gathered."""
    from headway.operators.histogram import delay_kpis

    rows = spark.createDataFrame([("r", "a", 1), ("r", "a", 1), ("r", "a", 5), ("r", "b", None), ("r", None, 5), (None, "a", 1)], "route_id string, trip_id string, delay_minutes long")
    kpis = delay_kpis(rows, ["route_id"])
    assert "collect_list" not in kpis._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["route_id"], r["stop_event_count"], r["trip_count"], r["median_delay_minutes"]) for r in kpis.collect()} == {("r", 5, 2, 3.0), (None, 1, 1, 1.0)}


def test_rows_are_dealt_by_trip_before_windows_multiply_them(spark):
    """Where no trip is hot, nothing is exchanged by (type, trip) after a row was entered for each type."""
    from headway.plans import catalog as C

    t = raw_transit(spark, SMOKE)
    mart = C.events_mart(t)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    exchanged = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert any(x.startswith("trip_id, ") and "event_type" not in x for x in exchanged)
    assert not any("trip_id" in x and "event_type" in x for x in exchanged)
    plain = C.WN.event_window_impact(C.enriched(t), t.event_windows)
    assert sorted(map(str, plain.collect())) == sorted(map(str, mart.collect()))


def test_the_stop_mart_reads_the_route_mart_as_written(spark, monkeypatch):
    from headway.plans import catalog as C

    made = []
    route = C.route_perf
    monkeypatch.setattr(C, "route_perf", lambda t: made.append(1) or route(t))
    rows, found = C._written_marts(raw_transit(spark, SMOKE))
    assert made == [1] and {name: got["total_events"] for name, got in found.items()} == dict.fromkeys(found, rows)
    assert list(found) == ["route_performance", "stop_performance", "route_hour_performance"]


def test_numbers_and_totals_come_from_one_pass(spark):
    """A group's running and whole sums share one window operator."""
    from pyspark.sql import functions as F

    from headway.operators.histogram import kpis_of_counts
    from headway.operators.median import median_count_mean
    from headway.operators.sequence import sequence_number

    rows = spark.createDataFrame([("a", 1, 1), ("a", 4, 1), ("a", None, 1), ("b", None, 1)], "k string, delay_minutes long, _n long")
    numbered = sequence_number(rows, "k", [F.asc_nulls_last("delay_minutes")], "seq", "cnt", force_split=False)
    medians = median_count_mean(rows, ["k"], "delay_minutes", "median", "mean", "n")
    kpis = kpis_of_counts(rows, ["k"])
    for df in (numbered, medians, kpis):
        assert len(re.findall(r"Window \[", df._jdf.queryExecution().optimizedPlan().toString())) == 1
    assert sorted((r["k"], r["seq"], r["cnt"]) for r in numbered.collect()) == [("a", 1, 3), ("a", 2, 3), ("a", 3, 3), ("b", 1, 1)]
    assert {(r["k"], r["n"], r["mean"], r["median"]) for r in medians.collect()} == {("a", 3, 2.5, 2.5), ("b", 1, None, None)}
    assert {(r["k"], r["stop_event_count"], r["median_delay_minutes"]) for r in kpis.collect()} == {("a", 3, 2.5), ("b", 1, None)}
