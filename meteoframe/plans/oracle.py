"""DuckDB oracle SQL for the registered queries.

Independent relational statements of each query over the same parquet
views, written from the rules (not generated from the Spark plans). A query
names the CTEs it needs; they are emitted in dependency order.
"""

from __future__ import annotations

from ..sources.tables import READINGS_SQL

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    _CTES[name] = (deps, body)


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in _CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(uses: tuple[str, ...] | list[str], final: str) -> str:
    parts = [f"{n} AS ({_CTES[n][1]})" for n in _order(uses)]
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


def on_wire(statement: str) -> str:
    """The same statement over readings whose event times have milliseconds, as
    envelopes carry them."""
    return statement.replace(f"readings AS ({READINGS_SQL})", (
        "readings AS (SELECT * REPLACE (date_trunc('millisecond', processing_timestamp) "
        f"AS processing_timestamp) FROM ({READINGS_SQL}) AS r)"))


def rnd6(expr: str) -> str:
    """Round to 6 decimals through a fixed-scale DECIMAL: one-ulp noise in
    the double disappears at scale 10, then HALF_UP applies exactly as in
    the Spark query (plain double rounding breaks exact ties differently)."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) THEN {x} "
            f"ELSE CAST(round(CAST({x} AS DECIMAL(38,10)), 6) AS DOUBLE) END)")


def r6(expr: str, alias: str) -> str:
    return f"{rnd6(expr)} AS {alias}"


SEC = "CAST(floor(epoch(processing_timestamp)) AS BIGINT)"

_cte("readings", (), READINGS_SQL)

_cte("cleaned", ("readings",), """
SELECT reading_id, device_id,
 CASE WHEN uv_index BETWEEN 0 AND 15 THEN uv_index END AS uv_index,
 CASE WHEN rain_gauge >= 0 THEN rain_gauge END AS rain_gauge,
 CASE WHEN wind_speed >= 0 THEN wind_speed END AS wind_speed,
 CASE WHEN air_humidity BETWEEN 0 AND 100 THEN air_humidity END AS air_humidity,
 CASE WHEN peak_wind_gust >= 0 THEN peak_wind_gust END AS peak_wind_gust,
 CASE WHEN air_temperature BETWEEN -50 AND 60 THEN air_temperature END AS air_temperature,
 CASE WHEN light_intensity >= 0 THEN light_intensity END AS light_intensity,
 CASE WHEN rain_accumulation >= 0 THEN rain_accumulation END AS rain_accumulation,
 CASE WHEN barometric_pressure BETWEEN 87000 AND 108000 THEN barometric_pressure END AS barometric_pressure,
 CASE WHEN wind_direction_sensor BETWEEN 0 AND 360 THEN wind_direction_sensor END AS wind_direction_sensor,
 processing_timestamp,
 strftime(processing_timestamp, '%Y-%m-%d') AS date
FROM readings WHERE valid = TRUE""")


def _mean(c: str) -> str:
    return (f"avg(CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END) "
            f"AS mean_{c}")


IMPUTE_COLS = ["air_temperature", "air_humidity", "wind_speed", "uv_index",
               "barometric_pressure", "peak_wind_gust", "light_intensity", "rain_accumulation"]
INT_COLS = {"air_humidity", "light_intensity", "barometric_pressure"}

_cte("means", ("cleaned",), "SELECT " + ", ".join(_mean(c) for c in IMPUTE_COLS) + " FROM cleaned")


def _fill(c: str) -> str:
    if c in INT_COLS:
        return f"coalesce({c}, CAST(trunc(mean_{c}) AS INTEGER)) AS {c}"
    return f"coalesce({c}, mean_{c}) AS {c}"



_cte("imputed", ("cleaned", "means"), f"""
SELECT reading_id, device_id, {_fill('uv_index')}, rain_gauge, {_fill('wind_speed')},
 {_fill('air_humidity')}, {_fill('peak_wind_gust')}, {_fill('air_temperature')},
 {_fill('light_intensity')}, {_fill('rain_accumulation')}, {_fill('barometric_pressure')},
 wind_direction_sensor, processing_timestamp, date
FROM cleaned CROSS JOIN means""")

FEATURES = ["air_temperature", "air_humidity", "wind_speed", "uv_index", "barometric_pressure"]

_cte("zstats", ("imputed",), "SELECT " + ", ".join(
    [f"avg({f}) AS mean_{f}" for f in FEATURES]
    + [f"stddev_samp({f}) AS stddev_{f}" for f in FEATURES]) + " FROM imputed")


def _z(f: str) -> str:
    return (f"(CASE WHEN mean_{f} IS NOT NULL AND stddev_{f} IS NOT NULL AND NOT isnan(stddev_{f}) "
            f"AND stddev_{f} > 0 THEN abs(({f} - mean_{f}) / stddev_{f}) ELSE 0.0 END)")


_cte("scored", ("imputed", "zstats"),
     "SELECT i.*, CAST(0.0 AS DOUBLE) + " + " + ".join(_z(f) for f in FEATURES)
     + " AS anomaly_score FROM imputed i CROSS JOIN zstats")

_cte("flagged", ("scored",), "SELECT *, anomaly_score > 10.0 AS is_anomaly FROM scored")


def daily_body(src: str, with_anomaly: bool = True) -> str:
    score = "max(anomaly_score)" if with_anomaly else "CAST(0.0 AS DOUBLE)"
    flag = ("CAST(max(CASE WHEN is_anomaly = TRUE THEN 1 ELSE 0 END) AS BOOLEAN)"
            if with_anomaly else "FALSE")
    return f"""
SELECT device_id, date,
 max(air_temperature) AS maxtemp_c, min(air_temperature) AS mintemp_c,
 avg(air_temperature) AS avgtemp_c, max(wind_speed * 3.6) AS maxwind_kph,
 sum(rain_gauge) AS totalprecip_mm, CAST(trunc(avg(air_humidity)) AS INTEGER) AS avghumidity,
 CASE WHEN sum(rain_gauge) > 0 THEN 1 ELSE 0 END AS daily_will_it_rain,
 CASE WHEN avg(air_humidity) > 70 AND avg(barometric_pressure) < 100000 THEN 70 ELSE 0 END AS daily_chance_of_rain,
 max(processing_timestamp) AS processing_timestamp,
 CAST(epoch(CAST(date AS DATE)::TIMESTAMP) AS INTEGER) AS date_epoch,
 {score} AS anomaly_score, {flag} AS is_anomaly
FROM {src} GROUP BY device_id, date"""


_cte("daily", ("flagged",), daily_body("flagged"))
_cte("daily_clean", ("cleaned",), daily_body("cleaned", with_anomaly=False))

DAILY_COLS = ("device_id, date, " + r6("maxtemp_c", "maxtemp_c") + ", "
              + r6("mintemp_c", "mintemp_c") + ", " + r6("avgtemp_c", "avgtemp_c")
              + ", maxwind_kph, totalprecip_mm, avghumidity, daily_will_it_rain, "
              "daily_chance_of_rain, processing_timestamp, date_epoch, "
              + r6("anomaly_score", "anomaly_score") + ", is_anomaly")

# --- series / QC ------------------------------------------------------------


def dedup_body(src: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY device_id, "
            f"processing_timestamp ORDER BY reading_id NULLS LAST) AS _rn FROM {src}) WHERE _rn = 1")


_cte("dedup_clean", ("cleaned",), dedup_body("cleaned"))
_cte("dedup_raw", ("readings",), dedup_body("readings"))
_cte("dedup_imputed", ("imputed",), dedup_body("imputed"))

W_DEV = "(PARTITION BY device_id ORDER BY processing_timestamp)"


def lag_body(src: str) -> str:
    return (f"SELECT *, ({SEC} - lag({SEC}) OVER {W_DEV}) / CAST(60.0 AS DOUBLE) AS time_diff, "
            f"air_temperature - lag(air_temperature) OVER {W_DEV} AS tair_step FROM {src}")


_cte("lag_clean", ("dedup_clean",), lag_body("dedup_clean"))
_cte("lag_raw", ("dedup_raw",), lag_body("dedup_raw"))

_cte("daily_metrics_clean", ("cleaned",), """
SELECT device_id, date, count(processing_timestamp) / CAST(96.0 AS DOUBLE) AS daily_valid_frac,
 sum(rain_gauge) AS daily_rain_mm FROM cleaned GROUP BY device_id, date""")


# Level-1 QC codes as SQL expressions (as written / corrected).
def code3(fail: str, warn: str | None, ok: str | None, mode: str) -> str:
    if mode == "corrected":
        parts = [f"WHEN {fail} THEN -2"]
        if ok:
            parts.append(f"WHEN {ok} THEN 1")
        if warn:
            parts.append(f"WHEN {warn} THEN 0")
    else:
        parts = [f"WHEN {fail} THEN -2"]
        if warn:
            parts.append(f"WHEN {warn} THEN 0")
    return "CASE " + " ".join(parts) + " ELSE 1 END"


def qc_exprs(mode: str) -> dict[str, str]:
    return {
        "QC_time_gap": ("CASE WHEN NOT (time_diff BETWEEN 14.0 AND 16.0) AND time_diff IS NOT NULL "
                        "THEN -1 ELSE 0 END"),
        "QC_Tair_range": code3("(air_temperature < 10.0 OR air_temperature > 45.0)",
                               "(air_temperature >= 10.0 AND air_temperature <= 45.0)",
                               "(air_temperature BETWEEN 12.0 AND 36.0)", mode),
        "QC_RH_range": code3("(air_humidity < 0.0 OR air_humidity > 100.0)",
                             "(air_humidity BETWEEN 0.0 AND 100.0)",
                             "(air_humidity BETWEEN 20.0 AND 100.0)", mode),
        "QC_WindSpeed_range": code3("(wind_speed < 0.0 OR wind_speed > 40.0)",
                                    "(wind_speed BETWEEN 0.0 AND 40.0)",
                                    "(wind_speed BETWEEN 0.0 AND 20.0)", mode),
        "QC_WindDir_range": code3("(wind_direction_sensor < 0.0 OR wind_direction_sensor > 360.0)",
                                  None, "(wind_direction_sensor BETWEEN 0.0 AND 360.0)", mode),
        "QC_WindDir_requires_wind": "CASE WHEN wind_speed < 0.3 THEN 0 ELSE 1 END",
        "QC_Rain_15min": code3("(rain_gauge < 0.0 OR rain_gauge > 40.0)",
                               "(rain_gauge > 20.0 AND rain_gauge <= 40.0)",
                               "(rain_gauge <= 20.0)", mode),
        "QC_Tair_step": code3("(abs(tair_step) > 5.0)", "(abs(tair_step) <= 5.0)",
                              "(abs(tair_step) <= 3.0)", mode),
        "QC_Daily_Availability": "CASE WHEN daily_valid_frac >= 0.8 THEN 1 ELSE 0 END",
        "QC_Rain_Daily": code3("(daily_rain_mm > 300.0)", "(daily_rain_mm <= 300.0)",
                               "(daily_rain_mm <= 150.0)", mode),
    }


QC_ORDER = ["QC_time_gap", "QC_Tair_range", "QC_RH_range", "QC_WindSpeed_range",
            "QC_WindDir_range", "QC_WindDir_requires_wind", "QC_Rain_15min", "QC_Tair_step",
            "QC_Daily_Availability", "QC_Rain_Daily"]


def name_lists(mode: str) -> str:
    fail = ", ".join(f"CASE WHEN {c} = -2 THEN '{c}' END" for c in QC_ORDER)
    warn_items = []
    for c in QC_ORDER:
        code = -1 if (mode == "corrected" and c == "QC_time_gap") else 0
        warn_items.append(f"CASE WHEN {c} = {code} THEN '{c}' END")
    warn = ", ".join(warn_items)
    return (f"list_filter([{fail}], lambda x: x IS NOT NULL) AS qc_failed_checks, "
            f"list_filter([{warn}], lambda x: x IS NOT NULL) AS qc_warning_checks")


def qc_chain(src_cte: str, prefix: str, mode: str) -> str:
    """Register the CTEs of the full level-1 chain over ``src_cte``; returns
    the name of the final CTE."""
    d, l, m, j, c = (f"{prefix}_{s}" for s in ("dd", "lag", "dm", "join", "codes"))
    _cte(d, (src_cte,), dedup_body(src_cte))
    _cte(l, (d,), f"""SELECT * REPLACE (CASE WHEN rain_gauge < 0 THEN CAST(0.0 AS DOUBLE) ELSE rain_gauge END AS rain_gauge),
 ({SEC} - lag({SEC}) OVER {W_DEV}) / CAST(60.0 AS DOUBLE) AS time_diff,
 air_temperature - lag(air_temperature) OVER {W_DEV} AS tair_step,
 CASE WHEN (SELECT median(barometric_pressure) FROM {d}) > 2000
      THEN CAST(barometric_pressure AS DOUBLE) / 100.0 ELSE CAST(barometric_pressure AS DOUBLE) END AS pressure_hpa
FROM {d}""")
    _cte(m, (l,), f"""SELECT device_id, date, count(processing_timestamp) / CAST(96.0 AS DOUBLE) AS daily_valid_frac,
 sum(rain_gauge) AS daily_rain_mm FROM {l} GROUP BY device_id, date""")
    _cte(j, (l, m), f"SELECT x.*, m.daily_valid_frac, m.daily_rain_mm FROM {l} x "
                    f"LEFT JOIN {m} m ON x.device_id = m.device_id AND x.date = m.date")
    ex = qc_exprs(mode)
    _cte(c, (j,), "SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in ex.items()) + f" FROM {j}")
    return c


QC_IMPUTED = qc_chain("imputed", "qci", "as_written")
QC_CLEAN_CORR = qc_chain("cleaned", "qcc", "corrected")
_cte("readings_dated", ("readings",),
     "SELECT *, strftime(processing_timestamp, '%Y-%m-%d') AS date FROM readings")

QC_RAW = qc_chain("readings_dated", "qcr", "as_written")
QC_RAW_CORR = qc_chain("readings_dated", "qcrc", "corrected")


# Per-device statistics (the corrected reading of per-batch global stats).
_cte("means_dev", ("cleaned",), "SELECT device_id, " + ", ".join(_mean(c) for c in IMPUTE_COLS)
     + " FROM cleaned GROUP BY device_id")
_cte("imputed_dev", ("cleaned", "means_dev"), f"""
SELECT c.reading_id, c.device_id, {_fill('uv_index')}, rain_gauge, {_fill('wind_speed')},
 {_fill('air_humidity')}, {_fill('peak_wind_gust')}, {_fill('air_temperature')},
 {_fill('light_intensity')}, {_fill('rain_accumulation')}, {_fill('barometric_pressure')},
 wind_direction_sensor, processing_timestamp, date
FROM cleaned c LEFT JOIN means_dev m ON c.device_id = m.device_id""")
_cte("zstats_dev", ("imputed_dev",), "SELECT device_id, " + ", ".join(
    [f"avg({f}) AS mean_{f}" for f in FEATURES]
    + [f"stddev_samp({f}) AS stddev_{f}" for f in FEATURES]) + " FROM imputed_dev GROUP BY device_id")
_cte("scored_dev", ("imputed_dev", "zstats_dev"),
     "SELECT i.*, CAST(0.0 AS DOUBLE) + " + " + ".join(_z(f) for f in FEATURES)
     + " AS anomaly_score FROM imputed_dev i LEFT JOIN zstats_dev z ON i.device_id = z.device_id")
