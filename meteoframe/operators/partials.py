"""Daily summaries from mergeable partial aggregates.

A *partial* holds, per (device, day), what the summary's measures need to be
merged: counts and sums in place of means, extremes, the latest event time,
whether any reading was flagged. Partials of any cut of the rows (micro-batches,
files, late arrivals) merge to the partial of all rows, and ``finish`` turns one
into the summary row that ``aggregate.daily_summary`` gives for those rows
(sums of floats up to their order). So a day is brought up to date from one
small row per device and the new readings, not from the readings it had.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from . import clean
from .aggregate import DAILY_MEASURES, Measure, rain_indicators

#: Aggregates that merge by being applied again.
_AGAIN: Mapping[str, Callable[[str], Column]] = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum,
                                                 "any": F.bool_or}


def _states(measures: Mapping[str, Measure], ts_col: str) -> dict[str, tuple[str, Column]]:
    """State column -> (how it merges, its aggregate over readings)."""
    out: dict[str, tuple[str, Column]] = {}

    def mean_of(column: str) -> None:
        x = F.col(column).cast("double")
        out[f"sum_{column}"] = ("sum", F.sum(x))
        out[f"count_{column}"] = ("count", F.count(x))

    for m in measures.values():
        if m.how == "avg":
            mean_of(m.column)
        else:
            out[f"{m.how}_{m.column}"] = (m.how, {"max": F.max, "min": F.min, "sum": F.sum}[m.how](F.col(m.column)))
    for column in ("air_humidity", "barometric_pressure"):
        mean_of(column)
    out["sum_rain_gauge"] = ("sum", F.sum(F.col("rain_gauge")))
    out[f"max_{ts_col}"] = ("max", F.max(ts_col))
    out["max_anomaly_score"] = ("max", F.max("anomaly_score"))
    out["any_anomaly"] = ("any", F.bool_or("is_anomaly"))
    return out


def daily_partials(df: DataFrame, keys: Sequence[str] = ("device_id", "date"),
                   ts_col: str = "processing_timestamp",
                   measures: Mapping[str, Measure] = DAILY_MEASURES) -> DataFrame:
    """One partial per ``keys`` of scored readings (columns and defaults as in
    ``aggregate.daily_summary``); combined in the map tasks before the shuffle."""
    rows = clean.with_defaults(clean.ensure_date(df, ts_col, keys[-1]), {"anomaly_score": 0.0, "is_anomaly": False})
    clean.require_columns(rows, S.DAILY_REQUIRED)
    return rows.groupBy(*keys).agg(*[a.alias(c) for c, (_, a) in _states(measures, ts_col).items()])


def merge(parts: DataFrame, keys: Sequence[str] = ("device_id", "date"), ts_col: str = "processing_timestamp",
          measures: Mapping[str, Measure] = DAILY_MEASURES) -> DataFrame:
    """One partial per ``keys`` from any number of them."""
    return parts.groupBy(*keys).agg(*[_AGAIN[how](c).alias(c) for c, (how, _) in _states(measures, ts_col).items()])


def finish(parts: DataFrame, keys: Sequence[str] = ("device_id", "date"), ts_col: str = "processing_timestamp",
           measures: Mapping[str, Measure] = DAILY_MEASURES) -> DataFrame:
    """The daily summary that merged partials stand for."""
    def mean(column: str) -> Column:
        n = F.col(f"count_{column}")
        return F.when(n > 0, F.col(f"sum_{column}") / n)

    def value(m: Measure) -> Column:
        x = mean(m.column) if m.how == "avg" else F.col(f"{m.how}_{m.column}")
        x = x * m.scale if m.scale != 1.0 else x
        return x.cast(m.kind) if m.kind else x

    rain = rain_indicators(F.col("sum_rain_gauge"), mean("air_humidity"), mean("barometric_pressure"))
    epoch = F.unix_timestamp(F.col(keys[-1]).cast("string"), P.DATE_FORMAT).cast("int")
    return parts.select(
        *keys, *[value(m).alias(name) for name, m in measures.items()], *[c.alias(name) for name, c in rain.items()],
        F.col(f"max_{ts_col}").alias(ts_col), epoch.alias("date_epoch"),
        F.col("max_anomaly_score").alias("anomaly_score"),
        F.coalesce("any_anomaly", F.lit(False)).alias("is_anomaly"))


def merge_slots(parts: DataFrame, key: str = "device_id") -> DataFrame:
    """Slot counts (as from ``aggregate.slot_availability``, with any further
    key columns) of several cuts of the readings, added up."""
    keys = [c for c in parts.columns if c != "n_readings"]
    return parts.groupBy(*keys).agg(F.sum("n_readings").alias("n_readings"))
