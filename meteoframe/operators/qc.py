"""Level-1 quality control: coded checks, name lists and the composite.

Codes: -2 fail, 0 warning, 1 ok (time gap: -1 irregular, 0 regular). Every
check is a column expression, so all of them land in one projection. The
composite needs two shuffles of the readings in total: the partially
aggregated de-duplication and one window pass that yields the time gap,
the temperature step and the daily metrics together (see ``series``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import rules as R
from ..functions.frames import attach_stats
from ..session import stage_table
from . import aggregate, series


def _thr(thr: Mapping | None) -> Mapping:
    return P.QC_THRESHOLDS if thr is None else thr


# ---------------------------------------------------------------- expressions

def time_gap_code(time_diff: str = "time_diff", lo: float = P.TIME_GAP_MIN,
                  hi: float = P.TIME_GAP_MAX) -> Column:
    """-1 when the gap is known and outside [lo, hi] minutes, else 0."""
    d = F.col(time_diff)
    irregular = ~d.between(lo, hi) & d.isNotNull()
    return F.when(irregular, F.lit(P.QC_GAP_IRREGULAR)).otherwise(F.lit(P.QC_GAP_REGULAR))


@dataclass(frozen=True)
class Band:
    """A check of one measure against bands whose edges are threshold names
    (None: open): fail outside [``low``, ``high``], ok inside [``ok_low``,
    ``ok_high``]; warn ``inside`` the fail limits, only ``above`` the ok band,
    or never (None). ``absolute`` checks the measure without its sign."""
    column: str
    low: str | None
    high: str | None
    ok_low: str | None
    ok_high: str | None
    warn: str | None = "inside"
    absolute: bool = False

    def code(self, thr: Mapping | None = None, mode: str = P.AS_WRITTEN, column: str | None = None) -> Column:
        edges = {None: None, **_thr(thr)}
        x = F.col(column or self.column)
        x = F.abs(x) if self.absolute else x
        low, high = edges[self.low], edges[self.high]
        beyond = [c for c, e in ((x < low, low), (x > high, high)) if e is not None]
        warn = {"inside": R.in_range(x, low, high), "above": (x > edges[self.ok_high]) & (x <= high), None: None}
        return R.qc_code(fail=reduce(Column.__or__, beyond), warn=warn[self.warn],
                         ok=R.in_range(x, edges[self.ok_low], edges[self.ok_high]), mode=mode)


#: The checks that compare one measure with bands.
BANDS = {
    "QC_Tair_range": Band("air_temperature", "Tair_min_phy", "Tair_max_phy", "Tair_warn_min_clim", "Tair_warn_max_clim"),
    "QC_RH_range": Band("air_humidity", "RH_min_phy", "RH_max_phy", "RH_warn_min_clim", "RH_max_phy"),
    "QC_WindSpeed_range": Band("wind_speed", "Wind_min_phy", "Wind_max_phy", "Wind_min_phy", "Wind_warn_max_clim"),
    "QC_WindDir_range": Band("wind_direction_sensor", "WindDir_min_phy", "WindDir_max_phy",
                             "WindDir_min_phy", "WindDir_max_phy", warn=None),
    "QC_Rain_15min": Band("rain_gauge", "Rain_min_inc", "Rain_max_15min", None, "Rain_warn_15min", warn="above"),
    "QC_Tair_step": Band("tair_step", None, "Tair_max_step_fail", None, "Tair_max_step_warn", absolute=True),
    "QC_Rain_Daily": Band("daily_rain_mm", None, "Rain_max_daily", None, "Rain_warn_daily"),
}


def winddir_requires_wind_code(thr=None, column="wind_speed") -> Column:
    """0 when the wind is too weak for a meaningful direction, else 1."""
    t = _thr(thr)
    return F.when(F.col(column) < t["WindDir_requires_wind"], F.lit(0)).otherwise(F.lit(1))


def daily_availability_code(thr=None, column="daily_valid_frac") -> Column:
    """1 when the day has enough readings, else 0 (unknown counts as 0)."""
    t = _thr(thr)
    return F.when(F.col(column) >= t["Min_daily_avail"], F.lit(1)).otherwise(F.lit(0))


def pressure_range_code(thr=None, mode=P.AS_WRITTEN, hpa="pressure_hpa",
                        dev="pressure_abs_dev_hpa") -> Column:
    """Pressure: fail outside [P_min_phy, P_max_phy] hPa or deviation above
    P_fail_abs_dev, warn below P_fail_abs_dev, ok below P_warn_abs_dev."""
    t, p, d = _thr(thr), F.col(hpa), F.col(dev)
    return R.qc_code(
        fail=(p < t["P_min_phy"]) | (p > t["P_max_phy"]) | (d > t["P_fail_abs_dev"]),
        warn=d < t["P_fail_abs_dev"],
        ok=d < t["P_warn_abs_dev"],
        mode=mode)


def check_code(name: str, thr: Mapping | None = None, mode: str = P.AS_WRITTEN) -> Column:
    """The code of the check ``name`` (a QC column)."""
    P.check_mode(mode)
    if name in BANDS:
        return BANDS[name].code(thr, mode)
    return {"QC_time_gap": time_gap_code,
            "QC_WindDir_requires_wind": lambda: winddir_requires_wind_code(thr),
            "QC_Daily_Availability": lambda: daily_availability_code(thr),
            "QC_Pressure_range": lambda: pressure_range_code(thr, mode)}[name]()


def failed_checks(columns=P.QC_COLUMNS) -> Column:
    """Names of the checks coded -2, in listing order."""
    return R.names_where(columns, code=P.QC_FAIL)


def warning_checks(columns=P.QC_COLUMNS, mode=P.AS_WRITTEN) -> Column:
    """Names of the checks coded 0, in listing order.

    The time gap uses another code set: ``as_written`` lists it on 0 (which
    means regular); ``corrected`` lists it on -1 (irregular).
    """
    P.check_mode(mode)
    pred = {c: F.col(c) == P.QC_WARN for c in columns}
    if mode == P.CORRECTED and "QC_time_gap" in pred:
        pred["QC_time_gap"] = F.col("QC_time_gap") == P.QC_GAP_IRREGULAR
    return R.names_where(columns, pred=pred)


# ------------------------------------------------------------ DataFrame steps

def add_checks(df: DataFrame, *names: str, thr: Mapping | None = None, mode: str = P.AS_WRITTEN) -> DataFrame:
    """``df`` with the code column of each check, in one projection."""
    return df.withColumns({n: check_code(n, thr, mode) for n in names})


def collect_qc_results(df, mode=P.AS_WRITTEN, columns=P.QC_COLUMNS):
    return df.withColumns({"qc_failed_checks": failed_checks(columns),
                           "qc_warning_checks": warning_checks(columns, mode)})


def _with_hpa(df: DataFrame, median: DataFrame, column: str = "barometric_pressure",
              out: str = "pressure_hpa") -> DataFrame:
    m = F.col(f"median_{column}")
    x = F.col(column).cast("double")
    conv = F.when(m > P.PA_MEDIAN_SWITCH, x / F.lit(P.PA_PER_HPA)).otherwise(x)
    return attach_stats(df, median).withColumn(out, conv).drop(f"median_{column}")


def convert_pressure_hpa(df: DataFrame, column: str = "barometric_pressure",
                         out: str = "pressure_hpa",
                         relative_error: float = P.MEDIAN_RELATIVE_ERROR) -> DataFrame:
    """Pressure in hPa: divided by 100 when the approximate median of the
    input exceeds 2000 (taken as Pa), else unchanged; DOUBLE.

    The median is a lazy one-row aggregate joined by broadcast (one row, so
    its size is fixed), not an eager driver round trip.
    """
    med = aggregate.approx_median(df, column, relative_error)
    return _with_hpa(df, med, column, out)


def expected_pressure(df: DataFrame, altitude_col: str = "altitude",
                      hpa: str = "pressure_hpa") -> DataFrame:
    """Expected station pressure from altitude (barometric formula) and the
    absolute deviation of the measured pressure. Unknown altitude counts as
    sea level; without the column every station is taken at sea level."""
    alt = (F.coalesce(F.col(altitude_col).cast("double"), F.lit(0.0))
           if altitude_col in df.columns else F.lit(0.0))
    expected = F.lit(P.SEA_LEVEL_HPA) * F.exp(-alt / F.lit(P.SCALE_HEIGHT_M))
    return df.withColumns({"p_expected_hpa": expected}).withColumn(
        "pressure_abs_dev_hpa", F.abs(F.col(hpa) - F.col("p_expected_hpa")))


def with_station(df: DataFrame, stations: DataFrame, columns: tuple = ("altitude",), key: str = "device_id",
                 ts_col: str = "processing_timestamp", since: str = "valid_from") -> DataFrame:
    """Attach ``columns`` of the station that a reading's device was at: the row
    of ``stations`` (``key``, ``since``, ``columns``) with the latest ``since``
    not after the reading. Null where there is none, or device or time is null.

    A device's rows become intervals (each ends where the next begins; equal
    ``since`` keep the greatest row), so at most one meets a reading and the
    join has an equality. Spark sends the stations to every task only if their
    measured size is under its broadcast threshold and shuffles them otherwise.
    """
    extra = F.struct(*[F.col(c) for c in columns])
    moves = (stations.filter(F.col(key).isNotNull() & F.col(since).isNotNull())
             .groupBy(F.col(key).alias("_key"), F.col(since).cast("timestamp").alias("_from"))
             .agg(F.max(extra).alias("_at")))
    moves = moves.withColumn("_until", F.lead("_from").over(Window.partitionBy("_key").orderBy("_from")))
    inside = ((F.col(key) == F.col("_key")) & (F.col(ts_col) >= F.col("_from"))
              & (F.col("_until").isNull() | (F.col(ts_col) < F.col("_until"))))
    own = [c for c in df.columns if c not in columns]
    return df.select(own).join(moves, inside, "left").select(*own, *[F.col(f"_at.{c}").alias(c) for c in columns])


# ------------------------------------------------------------------ composite

def qc_level1(df: DataFrame, thr: Mapping | None = None, mode: str = P.AS_WRITTEN,
              ts_col: str = "processing_timestamp", key: str = "device_id",
              date_col: str = "date", bucket_seconds=P.LAG_BUCKET_SECONDS,
              slots_per_day: float = P.SLOTS_PER_DAY, stage: bool = False,
              context: DataFrame | None = None, median: DataFrame | None = None) -> DataFrame:
    """All level-1 checks: de-duplicate on (device, time), time gap,
    negative rain to 0, pressure in hPa, range checks, temperature step,
    daily availability and rain, and the failed / warning name lists.

    The de-duplicated rows feed three branches (median, bucket table, row
    pass). Their de-duplication exchanges are identical, so adaptive
    execution runs that shuffle once and reuses it. ``stage=True`` instead
    writes the rows once under the checkpoint folder (a job starts here),
    cutting the lineage so a lost executor costs a re-read, not a re-shuffle.
    ``context`` holds earlier readings (device, date, timestamp,
    temperature) that precede the input, so time gaps and steps continue
    across micro-batches (see ``series.with_previous``). ``median`` (one row,
    `median_barometric_pressure`) decides the pressure unit in place of the
    input's own approximate median.
    """
    P.check_mode(mode)
    d = series.parse_and_dedup(df, ts_col, key)
    d = d.withColumn("rain_gauge", R.clip_negative("rain_gauge"))
    if stage:
        d = stage_table(d, "qc-dedup")
    # Median of the de-duplicated rows; applied after the lag pass so the
    # bucket-table branch does not carry the one-row join.
    if median is None:
        median = aggregate.approx_median(d, "barometric_pressure")
    base_cols = d.columns + ["pressure_hpa"]
    d = series.with_previous(
        d, [ts_col, "air_temperature"], ts_col, (key,), (date_col,),
        counts={"_n_ts": ts_col}, sums={"daily_rain_mm": "rain_gauge"},
        bucket_seconds=bucket_seconds, prefix="_prev_", context=context)
    d = _with_hpa(d, median)
    d = d.withColumns({
        "time_diff": (R.epoch_seconds(ts_col) - R.epoch_seconds(f"_prev_{ts_col}")) / F.lit(60.0),
        "tair_step": F.col("air_temperature") - F.col("_prev_air_temperature"),
        "daily_valid_frac": F.col("_n_ts") / F.lit(float(slots_per_day)),
    })
    d = add_checks(d, *P.QC_COLUMNS, thr=thr, mode=mode)
    d = collect_qc_results(d, mode)
    extra = ["time_diff", "pressure_hpa", "tair_step", "daily_valid_frac", "daily_rain_mm",
             *P.QC_COLUMNS, "qc_failed_checks", "qc_warning_checks"]
    return d.select(*[c for c in base_cols if c not in extra], *extra)
