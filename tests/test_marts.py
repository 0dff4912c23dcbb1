"""End-to-end mart build: every mart written, and event totals reconcile with the delay layer."""

import os

from pyspark.sql import functions as F

from headway.operators.audits import mart_null_audit
from headway.plans.marts import build_marts
from headway.sources.fixtures import AS_OF, load_transit
from tests.conftest import SMOKE
from tests.test_stream_marts import rows_of


def test_build_marts(spark, tmp_dir):
    t = load_transit(spark, SMOKE)
    out = build_marts(spark, t, os.path.join(tmp_dir, "marts"), AS_OF)
    expected = {
        "delay_preview_best_offset", "delay_weather_enriched", "route_performance", "route_hour_performance",
        "stop_performance", "unmatched_rt_trip_ids", "weather_impact", "route_weather_impact",
        "hour_day_reliability", "event_window_impact", "disruption_association", "risk_forecast_next_24h", "mart_reconciliation", "mart_null_audit",
    }
    assert set(out) == expected
    delay_rows = out["delay_preview_best_offset"].count()
    assert delay_rows > 0
    for mart in ("route_performance", "stop_performance", "route_hour_performance", "hour_day_reliability",
                 "weather_impact", "route_weather_impact"):
        assert out[mart].agg(F.sum("stop_event_count")).collect()[0][0] == delay_rows, mart
    checks = {r["mart_name"]: (r["total_events"], r["delay_rows"], r["reconciled"]) for r in out["mart_reconciliation"].collect()}
    assert checks == dict.fromkeys(("route_performance", "stop_performance", "route_hour_performance"), (delay_rows, delay_rows, True))
    assert rows_of(out["mart_null_audit"]) == rows_of(mart_null_audit(out["route_performance"]))
    assert out["delay_weather_enriched"].count() == delay_rows  # one weather row per hour here
    # Hours join the route-hour baseline (inner), so hours without baseline rows are absent.
    hours = out["risk_forecast_next_24h"].agg(F.min("forecast_hour_local_ts"), F.max("forecast_hour_local_ts"),
                                              F.countDistinct("forecast_hour_local_ts")).collect()[0]
    assert str(hours[0]) >= "2024-01-15 06:00:00" and str(hours[1]) <= "2024-01-16 05:00:00" and 0 < hours[2] <= 24
