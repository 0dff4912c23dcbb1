"""headway: schedule-alignment and delay analytics as Spark DataFrame operators.

Observed stop arrivals (a realtime feed) are aligned to a static timetable per
trip, turned into a delay layer in local wall-clock time, and rolled up into
route, stop, hour, weather, event-window and risk tables.  Every operator takes
and returns DataFrames; the physical plan is left to Catalyst and AQE.
"""

from headway.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
