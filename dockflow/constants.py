"""Numbers, lists and labels that decide the results.

Everything here is data, kept in its natural order. Logic lives in ``functions``.
"""

# --- fixed values: ride validity -------------------------------------------------------------
MIN_RIDE_SECONDS = 60
MAX_RIDE_SECONDS = 86400

# --- fixed values: station validity (inclusive) ----------------------------------------------
STATION_LAT = (51.3, 51.7)
STATION_LON = (-0.6, 0.3)

# --- fixed values: zones as (name, lat low, lat high, lon low, lon high), first match wins ----
ZONE_BOXES = [
    ("City & Shoreditch", 51.505, 51.525, -0.105, -0.070),
    ("Westminster & Victoria", 51.493, 51.512, -0.150, -0.115),
    ("Waterloo & Southbank", 51.495, 51.512, -0.115, -0.090),
    ("Camden & Islington", 51.525, 51.560, -0.150, -0.085),
    ("East End & Canary Wharf", 51.495, 51.530, -0.060, 0.030),
    ("Kensington & Chelsea", 51.480, 51.512, -0.220, -0.150),
]
ZONE_ELSE = "Other"

# --- fixed values: categories ------------------------------------------------------------------
CAPACITY_TIERS = ["small", "medium", "large"]
DURATION_BANDS = ["short", "medium", "long", "extended"]
EDA_BANDS = [
    ("short (<10m)", 0, 10),
    ("medium (10–30m)", 10, 30),
    ("long (30–60m)", 30, 60),
    ("extended (>60m)", 60, 1440),
]
PRIORITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
SEASONS = ["winter", "spring", "summer", "autumn"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# --- fixed values: hours of day ------------------------------------------------------------------
PEAK_HOURS = [7, 8, 17, 18]
AM_PERIOD_HOURS = [7, 8, 9]
PM_PERIOD_HOURS = [17, 18, 19]
AM_PERIOD = "AM Peak (07–09)"
PM_PERIOD = "PM Peak (17–19)"
COMMUTER_HOURS = [7, 8, 9, 17, 18, 19]
LEISURE_HOURS = [10, 11, 12, 13, 14, 15, 16]
NIGHT_HOURS = [20, 21, 22, 23, 0, 1, 2]

# --- fixed values: imbalance ---------------------------------------------------------------------
IMBALANCED_ABOVE = 0.2
# Lower edge of MEDIUM, HIGH and CRITICAL. "closed" names the side that owns the edge value.
PRIORITY_POLICIES = {
    "mart": {"edges": (0.10, 0.18, 0.25), "closed": "left"},
    "ops": {"edges": (0.10, 0.18, 0.25), "closed": "right"},
    "legacy": {"edges": (0.1, 0.3, 0.5), "closed": "right"},
}
# The right-closed policies accept scores in (-0.01, 1.01].
SCORE_RANGE = (-0.01, 1.01)

ACTION_DELIVER = "DELIVER BIKES"
ACTION_COLLECT = "COLLECT BIKES"
ACTION_MONITOR = "MONITOR"
STATIONS_PER_RUN = 15
# (score at least, label, hours to clear); anything lower falls to URGENCY_ELSE.
URGENCY_TIERS = [(0.40, "immediately", 2), (0.25, "urgently", 4)]
URGENCY_ELSE = ("today", 6)

# --- fixed values: marker colours ------------------------------------------------------------------
# (score below, hex, red, green, blue)
MAP_COLOURS = [
    (0.1, "#22C55E", 34, 197, 94),
    (0.3, "#EAB308", 234, 179, 8),
    (0.5, "#F97316", 249, 115, 22),
]
MAP_COLOUR_ELSE = ("#EF4444", 239, 68, 68)
# (score at least, hex)
SCENARIO_COLOURS = [(0.25, "#9a031e"), (0.18, "#e36414"), (0.10, "#f6bd60")]
SCENARIO_COLOUR_ELSE = "#a7c957"

# --- fixed values: date dimension -------------------------------------------------------------------
SPINE_START = "2015-01-01"
SPINE_END = "2025-12-31"  # exclusive
MART_HOLIDAYS = [
    ("2023-01-02", "New Year Holiday"),
    ("2023-04-07", "Good Friday"),
    ("2023-04-10", "Easter Monday"),
    ("2023-05-01", "Early May Bank Holiday"),
    ("2023-05-29", "Spring Bank Holiday"),
    ("2023-08-28", "Summer Bank Holiday"),
    ("2023-12-25", "Christmas Day"),
    ("2023-12-26", "Boxing Day"),
    ("2024-01-01", "New Year Day"),
    ("2024-03-29", "Good Friday"),
    ("2024-04-01", "Easter Monday"),
    ("2024-05-06", "Early May Bank Holiday"),
    ("2024-05-27", "Spring Bank Holiday"),
    ("2024-08-26", "Summer Bank Holiday"),
    ("2024-12-25", "Christmas Day"),
    ("2024-12-26", "Boxing Day"),
]

# --- fixed values: holidays of the demand features ------------------------------------------------
ML_HOLIDAYS = [
    "2020-01-01", "2020-04-10", "2020-04-13", "2020-05-08", "2020-05-25",
    "2020-08-31", "2020-12-25", "2020-12-28",
    "2021-01-01", "2021-04-02", "2021-04-05", "2021-05-03", "2021-05-31",
    "2021-08-30", "2021-12-27", "2021-12-28",
    "2022-01-03", "2022-04-15", "2022-04-18", "2022-05-02", "2022-06-02",
    "2022-06-03", "2022-08-29", "2022-09-19", "2022-12-26", "2022-12-27",
    "2023-01-02", "2023-04-07", "2023-04-10", "2023-05-01", "2023-05-08",
    "2023-05-29", "2023-08-28", "2023-12-25", "2023-12-26",
    "2024-01-01", "2024-03-29", "2024-04-01", "2024-05-06", "2024-05-27",
    "2024-08-26", "2024-12-25", "2024-12-26",
]

# --- fixed values: forecast ---------------------------------------------------------------------------
HOUR_WEIGHTS = [
    0.30, 0.15, 0.10, 0.10, 0.20, 0.50, 1.20, 3.80, 4.50, 2.50, 1.80, 1.60,
    2.20, 1.80, 1.60, 1.70, 2.40, 4.20, 3.60, 2.20, 1.50, 1.10, 0.70, 0.45,
]
FALLBACK_SCALE = (0.5, 2.0)
FALLBACK_RIDES = 4.5
BUFFER_SHARE = 0.25

# --- fixed values: demand features and models ------------------------------------------------------
FEATURE_COLUMNS = [
    "hour",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    "season",
    "start_station_id",
    "rolling_7d_avg",
]
LABEL_COLUMN = "ride_count"
ROLLING_ROWS = 7

# --- fixed values: surrogate keys --------------------------------------------------------------------
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# --- fixed values: segment labels --------------------------------------------------------------------
SEGMENTS_4 = ["🚆 Commuter", "🌿 Weekend Leisure", "☀️ Midday Explorer", "🌙 Evening/Night Rider"]
SEGMENTS_3 = ["Commuter", "Leisure", "Casual"]
