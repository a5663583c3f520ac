"""Reference statistics over a sliding period, from mergeable moments.

A device-day's readings are summed up once as moments of every column (count,
mean, squared deviations, NaN count); moments of any cut of a day, such as
micro-batches, merge to the day's. The reference of a day is the merge of the
device's days before it within the period: days enter and leave by whole rows of
moments, and no reading is read again. A window frame holds at most as many rows
as the period has days, whatever the number of readings.

Merging follows the pairwise rule: with N = sum n and M = sum(n * mean) / N the
squared deviations are sum(m2 + n * (mean - M)^2), which cancels no digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from . import anomaly, impute

KEYS = ("device_id", "date")


def day_moments(df: DataFrame, columns: Sequence[str] = P.ANOMALY_FEATURES,
                keys: Sequence[str] = KEYS) -> DataFrame:
    """Moments of each column per device and day (or any ``keys``)."""
    return impute.column_moments(df, columns, keys)


def _state(c: str) -> Column:
    return F.struct(F.col(f"n_{c}").alias("n"), F.col(f"mean_{c}").alias("mean"), F.col(f"m2_{c}").alias("m2"),
                    F.col(f"nan_{c}").alias("nan"))


def _merged(states: str, c: str) -> list[str]:
    """Moments of column ``c`` from the array column ``states`` of them."""
    n = f"aggregate({states}, 0L, (a, s) -> a + s.n)"
    mean = f"aggregate({states}, 0D, (a, s) -> a + s.n * coalesce(s.mean, 0D)) / nullif({n}, 0L)"
    m2 = (f"aggregate({states}, 0D, (a, s) -> a + coalesce(s.m2, 0D)"
          f" + s.n * pow(coalesce(s.mean, 0D) - coalesce(`mean_{c}`, 0D), 2))")
    return [f"{n} AS `n_{c}`", f"{mean} AS `mean_{c}`", f"aggregate({states}, 0L, (a, s) -> a + s.nan) AS `nan_{c}`", m2]


def _from_states(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Merge the arrays ``_s_<c>`` of each row."""
    first, second = [], []
    for c in columns:
        *own, m2 = _merged(f"`_s_{c}`", c)
        first += [*own, f"`_s_{c}`"]
        second += [f"`n_{c}`", f"`mean_{c}`", f"`nan_{c}`", f"{m2} AS `m2_{c}`"]
    kept = [f"`{k}`" for k in keep]
    return df.selectExpr(*kept, *first).selectExpr(*kept, *second)


def merge_moments(parts: DataFrame, columns: Sequence[str] = P.ANOMALY_FEATURES,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """One row of moments per ``keys`` from those of any cut of its readings
    (as many rows a key as there are cuts, not readings)."""
    rows = parts.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"),
                                    *[F.collect_list(_state(c)).alias(f"_s_{c}") for c in columns])
    return _from_states(rows, [*keys, "n_rows"], columns)


def sliding_stats(moments: DataFrame, days: int = 7, columns: Sequence[str] = P.ANOMALY_FEATURES,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """`mean_<c>` and `stddev_<c>` per device and day over the device's ``days``
    calendar days before it (its own left out). A day without earlier ones in
    the period has nulls; a NaN in the period makes both NaN."""
    device, day = keys
    number = F.unix_date(F.to_date(day))
    frame = Window.partitionBy(device).orderBy("_day").rangeBetween(-days, -1)
    rows = moments.withColumn("_day", number).filter(F.col("_day").isNotNull())
    rows = rows.select(*keys, *[F.collect_list(_state(c)).over(frame).alias(f"_s_{c}") for c in columns])
    out = _from_states(rows, keys, columns)
    stats = [*keys]
    for c in columns:
        nan = F.col(f"nan_{c}") > 0
        n = F.col(f"n_{c}")
        stats += [F.when(nan, F.lit(float("nan"))).otherwise(F.col(f"mean_{c}")).alias(f"mean_{c}"),
                  F.when(nan, F.lit(float("nan"))).when(n > 1, F.sqrt(F.col(f"m2_{c}") / (n - 1))).alias(f"stddev_{c}")]
    return out.select(*stats)


def score_running(df: DataFrame, moments: DataFrame, days: int = 7,
                  features: Sequence[str] = P.ANOMALY_FEATURES, keys: Sequence[str] = KEYS) -> DataFrame:
    """Z-score anomaly scores against each device's ``days`` days before. A
    first day has no reference: score 0.0, no flag."""
    return anomaly.zscore_score(df, features, stats=sliding_stats(moments, days, features, keys), by=keys)
