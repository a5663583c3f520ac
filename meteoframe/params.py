"""Rule parameters shared by the operators.

Everything below the marker is a fixed value: these numbers, names and
formats must equal the reference pipeline's for results to match, so they
are stated plainly and in their natural order. Operators take them as
defaults and accept overrides.
"""

from __future__ import annotations

from types import MappingProxyType

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference pipeline's)
# ---------------------------------------------------------------------------

# Event-time text format of `created_at` ('Z' is a quoted literal).
CREATED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Date key format.
DATE_FORMAT = "yyyy-MM-dd"

# Cleaning: keep a value inside [lo, hi] (inclusive), else null. None = open.
CLEAN_RANGES = MappingProxyType({
    "air_temperature": (-50, 60),
    "air_humidity": (0, 100),
    "wind_speed": (0, None),
    "uv_index": (0, 15),
    "barometric_pressure": (87000, 108000),
    "rain_gauge": (0, None),
    "rain_accumulation": (0, None),
    "peak_wind_gust": (0, None),
    "light_intensity": (0, None),
    "wind_direction_sensor": (0, 360),
})

# Mean imputation columns.
IMPUTE_COLUMNS = (
    "air_temperature", "air_humidity", "wind_speed",
    "uv_index", "barometric_pressure", "peak_wind_gust",
    "light_intensity", "rain_accumulation",
)

# Z-score anomaly features and flag threshold (strictly greater).
ANOMALY_FEATURES = (
    "air_temperature", "air_humidity", "wind_speed", "uv_index", "barometric_pressure",
)
ANOMALY_THRESHOLD = 10.0

# Daily summary constants.
KMH_PER_MS = 3.6
RAIN_CHANCE_HUMIDITY = 70
RAIN_CHANCE_PRESSURE = 100000
RAIN_CHANCE_VALUE = 70

# Quality-control thresholds (level 1).
QC_THRESHOLDS = MappingProxyType({
    "Tair_min_phy": 10.0, "Tair_max_phy": 45.0,
    "Tair_warn_min_clim": 12.0, "Tair_warn_max_clim": 36.0,
    "Tair_max_step_warn": 3.0, "Tair_max_step_fail": 5.0,
    "RH_min_phy": 0.0, "RH_max_phy": 100.0, "RH_warn_min_clim": 20.0,
    "Rain_min_inc": 0.0, "Rain_warn_15min": 20.0, "Rain_max_15min": 40.0,
    "Rain_warn_daily": 150.0, "Rain_max_daily": 300.0,
    "Wind_min_phy": 0.0, "Wind_warn_max_clim": 20.0, "Wind_max_phy": 40.0,
    "WindDir_min_phy": 0.0, "WindDir_max_phy": 360.0, "WindDir_requires_wind": 0.3,
    "P_min_phy": 750.0, "P_max_phy": 1010.0, "P_warn_abs_dev": 25.0, "P_fail_abs_dev": 40.0,
    "Min_daily_avail": 0.8,
})

# Regular time-gap band in minutes (inclusive).
TIME_GAP_MIN = 14.0
TIME_GAP_MAX = 16.0

# Expected readings per day (15-minute slots).
SLOTS_PER_DAY = 96.0

# Pa -> hPa switch: a median above this is taken to be in Pa.
PA_MEDIAN_SWITCH = 2000.0
PA_PER_HPA = 100.0
MEDIAN_RELATIVE_ERROR = 0.01

# Barometric altitude model (optional pressure check).
SEA_LEVEL_HPA = 1013.25
SCALE_HEIGHT_M = 8434.0

# QC codes.
QC_FAIL = -2
QC_WARN = 0
QC_OK = 1
QC_GAP_IRREGULAR = -1
QC_GAP_REGULAR = 0

# QC output columns, in listing order.
QC_COLUMNS = (
    "QC_time_gap",
    "QC_Tair_range",
    "QC_RH_range",
    "QC_WindSpeed_range",
    "QC_WindDir_range",
    "QC_WindDir_requires_wind",
    "QC_Rain_15min",
    "QC_Tair_step",
    "QC_Daily_Availability",
    "QC_Rain_Daily",
)

# ---------------------------------------------------------------------------
# Our own choices (not from the reference)
# ---------------------------------------------------------------------------

AS_WRITTEN = "as_written"
CORRECTED = "corrected"
MODES = (AS_WRITTEN, CORRECTED)

# Width of the time buckets that bound per-device window partitions.
LAG_BUCKET_SECONDS = 3600


def check_mode(mode: str) -> str:
    """Validate a rule mode name."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def thresholds(overrides: dict | None = None) -> dict:
    """QC thresholds with optional overrides (unknown keys are rejected)."""
    thr = dict(QC_THRESHOLDS)
    for k, v in (overrides or {}).items():
        if k not in thr:
            raise KeyError(f"unknown QC threshold {k!r}")
        thr[k] = float(v)
    return thr
