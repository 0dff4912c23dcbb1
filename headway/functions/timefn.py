"""Time helpers (Column -> Column), all independent of the session time zone.

Local wall-clock values are TIMESTAMP_NTZ.  Instants come in as unix seconds.
Nothing here casts between TIMESTAMP and TIMESTAMP_NTZ, because that cast goes
through ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.constants import WEATHER_TIME_FORMATS

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock_from_seconds(wall_seconds_col: Column | str) -> Column:
    """Seconds since 1970-01-01 00:00 (wall clock) -> TIMESTAMP_NTZ."""
    secs = _col(wall_seconds_col).cast("decimal(18,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def local_epoch_seconds(epoch_seconds: Column | str, tz: str) -> Column:
    """Unix seconds -> seconds since 1970-01-01 00:00 on the wall clock of ``tz``.

    from_utc_timestamp shifts the instant by the zone offset in effect (DST
    aware) and unix_seconds reads the shifted value back; neither consults
    the session zone.  One zone lookup per row, then plain long arithmetic.
    """
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(_col(epoch_seconds)), F.lit(tz)))


def utc_wall_clock(epoch_seconds: Column | str) -> Column:
    """Unix seconds -> UTC wall clock as TIMESTAMP_NTZ."""
    return wall_clock_from_seconds(epoch_seconds)


def local_wall_clock(epoch_seconds: Column | str, tz: str) -> Column:
    """Unix seconds -> wall clock in ``tz`` (TIMESTAMP_NTZ), DST aware."""
    return wall_clock_from_seconds(local_epoch_seconds(epoch_seconds, tz))


def floor_div(x: Column, d: int) -> Column:
    return ((x - F.pmod(x, F.lit(d))) / d).cast("bigint")


def scheduled_wall_seconds(local_seconds: Column, hms: Column | str) -> Column:
    """Wall seconds of service-day midnight (the local date of ``local_seconds``) + H:MM:SS."""
    return local_seconds - F.pmod(local_seconds, F.lit(86400)) + hms_seconds(hms)


def minute_diff_seconds(start_seconds: Column, end_seconds: Column) -> Column:
    """minute_diff on wall-clock seconds: minute boundaries crossed."""
    return floor_div(end_seconds, 60) - floor_div(start_seconds, 60)


def hms_part(hms: Column | str, k: int) -> Column:
    """k-th ':'-separated field of an H:MM:SS string as int (hours may be >= 24)."""
    return F.element_at(F.split(_col(hms), ":"), k).cast("int")  # one split serves all fields


def hms_seconds(hms: Column | str) -> Column:
    """H:MM:SS -> seconds after service-day midnight (may exceed 86400)."""
    return hms_part(hms, 1) * 3600 + hms_part(hms, 2) * 60 + hms_part(hms, 3)


def scheduled_wall_clock(service_date: Column | str, hms: Column | str) -> Column:
    """Midnight of ``service_date`` plus H:MM:SS; hours >= 24 roll into the next day."""
    return _col(service_date).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hms_part(hms, 1), hms_part(hms, 2), hms_part(hms, 3).cast("decimal(18,6)")
    )


def wall_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (as bigint)."""
    return floor_div(wall_micros(ts), 1_000_000)


def wall_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (as bigint), by long arithmetic on one interval."""
    since = _col(ts) - F.expr(_EPOCH_NTZ)
    seconds = since.cast("bigint")
    rest = since - F.expr("INTERVAL '1' SECOND") * seconds
    return seconds * 1_000_000 + (rest * 1_000_000).cast("bigint")


def minute_diff(start: Column | str, end: Column | str) -> Column:
    """Signed count of minute boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:01:00 is 1, as in date_diff('minute', ...); elapsed-time
    differences (timestampdiff) would give 0.
    """

    return minute_diff_seconds(wall_seconds(_col(start)), wall_seconds(_col(end)))


def seconds_of_day(ts: Column | str) -> Column:
    """hour * 3600 + minute * 60 + second of a wall-clock timestamp."""
    t = _col(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def circular_seconds_distance(observed_sod: Column, scheduled_sec: Column) -> Column:
    """Distance on a 24 h clock between a second-of-day and a schedule second."""
    d = F.abs(observed_sod - F.pmod(scheduled_sec, F.lit(86400)))
    return F.when(d <= 43200, d).otherwise(F.lit(86400) - d)


def trunc_hour(ts: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour without a session-zone round trip."""
    t = _col(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)
    )


def day_of_week_num(ts: Column | str) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_col(ts)) - 1).cast("int")


# Date, time and optional seconds, separated by a blank or 'T'.  The four
# accepted layouts are listed in WEATHER_TIME_FORMATS.
_WEATHER_TIME_RE = r"^(\d{4})-(\d{2})-(\d{2})[ T](\d{2}):(\d{2})(:(\d{2}))?$"


def parse_local_time(text: Column | str) -> Column:
    """Parse a local timestamp string in any of WEATHER_TIME_FORMATS, else NULL."""
    assert len(WEATHER_TIME_FORMATS) == 4
    t = _col(text)

    def part(i: int) -> Column:
        return F.regexp_extract(t, _WEATHER_TIME_RE, i).try_cast("int")

    secs = F.when(F.regexp_extract(t, _WEATHER_TIME_RE, 7) == "", F.lit(0)).otherwise(part(7))
    return F.when(
        t.rlike(_WEATHER_TIME_RE),
        F.try_make_timestamp_ntz(part(1), part(2), part(3), part(4), part(5), secs),
    )


def parse_local_hour(text: Column | str) -> Column:
    """Parse like :func:`parse_local_time` and truncate to the hour in one step.

    Building the hour straight from the text fields keeps the expression
    small (the text is read by one regex per field, not re-parsed per field).
    """
    t = _col(text)

    def part(i: int) -> Column:
        return F.regexp_extract(t, _WEATHER_TIME_RE, i).try_cast("int")

    secs = F.when(F.regexp_extract(t, _WEATHER_TIME_RE, 7) == "", F.lit(0)).otherwise(part(7))
    valid = t.rlike(_WEATHER_TIME_RE) & (part(5) <= 59) & (secs <= 59)
    return F.when(valid, F.try_make_timestamp_ntz(part(1), part(2), part(3), part(4), F.lit(0), F.lit(0)))
