"""Build the staging and mart tables in one run.

The delay layer feeds every mart, directly or through another mart, so it is
computed once and written as a table (partitioned by local service date for
later pruning); the marts then read that table.  A written table cuts the
lineage: a lost executor costs a re-read, not a re-alignment.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from headway.functions import constants as K
from headway.operators import align as A
from headway.operators import delay as DL
from headway.operators import kpi
from headway.operators import risk as RK
from headway.operators import weather as W
from headway.operators import windows as WN
from headway.sources.fixtures import TransitTables
from headway.sources.observed import event_totals, null_audit, null_counts, reconciliation, rows_written, write_observed
from headway.sources.tables import write_table

#: Marts whose stop events add up to the rows of the delay layer.
RECONCILED_MARTS = ("route_performance", "stop_performance", "route_hour_performance")


@dataclass
class MartPaths:
    root: str

    def __getitem__(self, name: str) -> str:
        return os.path.join(self.root, name)


def build_marts(
    spark: SparkSession,
    t: TransitTables,
    out_dir: str,
    as_of: str,
    tz: str = K.DEFAULT_TZ,
) -> dict[str, DataFrame]:
    """Write staging and mart tables under ``out_dir``; return them re-read from storage.

    Two more tables come from figures that the writes observed: ``mart_reconciliation`` and ``mart_null_audit``.
    """
    paths = MartPaths(out_dir)

    aligned = A.align_best_offset(t.rt_updates, t.stop_times, t.trips, t.stops, tz=tz)
    written = write_observed(DL.delay_layer(aligned, tz), paths["delay_preview_best_offset"], rows_written(), partition_by=["service_date_local"])
    delay = spark.read.parquet(paths["delay_preview_best_offset"])

    enriched = W.enrich_weather(delay, t.weather)
    write_table(enriched, paths["delay_weather_enriched"], partition_by=["service_date_local"])
    enriched = spark.read.parquet(paths["delay_weather_enriched"])

    route = kpi.route_performance(delay, t.rt_updates, t.trips)
    seen = {"route_performance": write_observed(route, paths["route_performance"], {**event_totals(), **null_counts()})}
    route = spark.read.parquet(paths["route_performance"])
    route_hour = kpi.route_hour_performance(delay, t.rt_updates, t.trips, tz)
    seen["route_hour_performance"] = write_observed(route_hour, paths["route_hour_performance"], event_totals())
    route_hour = spark.read.parquet(paths["route_hour_performance"])

    outputs = {
        "stop_performance": kpi.stop_performance(delay, route),
        "unmatched_rt_trip_ids": kpi.unmatched_trips(t.rt_updates, delay),
        "weather_impact": W.weather_impact(enriched),
        "route_weather_impact": W.route_weather_impact(enriched),
        "hour_day_reliability": RK.hour_day_reliability(delay),
        "event_window_impact": WN.event_window_impact(enriched, t.event_windows),
        "disruption_association": WN.disruption_association(enriched, t.alert_windows),
        "risk_forecast_next_24h": RK.risk_forecast(route_hour, t.weather, as_of),
    }
    for name, df in outputs.items():
        if name in RECONCILED_MARTS:
            seen[name] = write_observed(df, paths[name], event_totals())
        else:
            write_table(df, paths[name])
    checks = {
        "mart_reconciliation": reconciliation(spark, written["row_count"], {name: seen[name] for name in RECONCILED_MARTS}),
        "mart_null_audit": null_audit(spark, seen["route_performance"]),
    }
    for name, df in checks.items():
        write_table(df, paths[name])

    tables = {
        "delay_preview_best_offset": delay,
        "delay_weather_enriched": enriched,
        "route_performance": route,
        "route_hour_performance": route_hour,
    }
    tables.update({name: spark.read.parquet(paths[name]) for name in [*outputs, *checks]})
    return tables
