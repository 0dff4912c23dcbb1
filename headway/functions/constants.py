"""Fixed values that results must reproduce exactly.

FIXED VALUES — labels, thresholds and steps of the published method.  They are
part of the output contract (mart columns hold these strings and numbers), so
they are stated here once, plainly, in natural order.
"""

# Service area time zone of the timetable and the realtime feed.
DEFAULT_TZ = "America/Los_Angeles"

# Day names by day-of-week number, Sunday = 0.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# On-time threshold (minutes): delay <= 5 is on time, > 5 is delayed.
ON_TIME_MAX_MINUTES = 5

# Outlier thresholds (minutes).
SEVERE_LATE_MINUTES = 60
EARLY_OUTLIER_MINUTES = -10

# Delay categories: half-open bands, label applies when delay < upper bound.
DELAY_CATEGORIES = [
    (-10, "Early >10min"),
    (0, "Early 0-10min"),
    (5, "On-time (0-5min)"),
    (15, "Minor delay (5-15min)"),
    (30, "Moderate (15-30min)"),
    (60, "Major (30-60min)"),
]
DELAY_CATEGORY_ELSE = "Severe >60min"

# Offset buckets: 0, 1-5, 6-10, 11+.
OFFSET_BUCKETS = ["0", "1-5", "6-10", "11+"]

# Precipitation buckets (mm): unknown (NULL), dry (= 0), light (0, 1),
# moderate [1, 5), heavy otherwise.
PRECIP_UNKNOWN = "unknown"
PRECIP_DRY = "dry"
PRECIP_LIGHT = "light_rain"
PRECIP_MODERATE = "moderate_rain"
PRECIP_HEAVY = "heavy_rain"
PRECIP_LIGHT_MAX = 1.0
PRECIP_MODERATE_MAX = 5.0

# Risk score steps added to the baseline average delay.
RAIN_STEPS = [(5.0, 6.0), (1.0, 3.0)]  # (precipitation >= mm, add minutes)
RAIN_ANY_STEP = 1.5                    # precipitation > 0
WIND_STEPS = [(35.0, 2.0), (20.0, 1.0)]  # (windspeed >= km/h, add minutes)
PROBABILITY_PER_MINUTE = 2.5
RISK_HIGH_MINUTES = 15.0
RISK_MEDIUM_MINUTES = 8.0
RISK_LEVELS = ["high", "medium", "low"]
FORECAST_HORIZON_HOURS = 24

# Label used for rows outside every event or alert window.
NO_WINDOW_TYPE = "none"

# Accepted weather timestamp layouts, tried in this order.
WEATHER_TIME_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm",
]
