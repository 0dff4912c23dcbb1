"""Column -> Column building blocks (time arithmetic, rounding, labels)."""

from headway.functions.labels import (  # noqa: F401
    day_name,
    delay_category,
    delayed,
    is_raining,
    offset_bucket,
    offset_bucket_rank,
    on_time,
    precipitation_bucket,
    rain_step,
    risk_level,
    wind_step,
)
from headway.functions.numeric import count_when, pct, pct_or_zero, round_half, sum_when  # noqa: F401
from headway.functions.timefn import (  # noqa: F401
    circular_seconds_distance,
    floor_div,
    local_epoch_seconds,
    minute_diff_seconds,
    scheduled_wall_seconds,
    wall_clock_from_seconds,
    day_of_week_num,
    hms_part,
    hms_seconds,
    local_wall_clock,
    minute_diff,
    parse_local_hour,
    parse_local_time,
    scheduled_wall_clock,
    seconds_of_day,
    trunc_hour,
    utc_wall_clock,
    wall_seconds,
)
