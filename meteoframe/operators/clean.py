"""Validity filter, range cleaning, date key and small column utilities.

All operators are lazy ``DataFrame -> DataFrame`` transforms; the counting
helpers return one-row aggregates instead of running jobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions import rules as R


def filter_valid(df: DataFrame, valid_col: str = "valid") -> DataFrame:
    """Keep rows whose flag is true; false and null are dropped.
    Without the column the input passes unchanged."""
    if valid_col not in df.columns:
        return df
    return df.filter(F.col(valid_col) == F.lit(True))


def valid_counts(df: DataFrame, valid_col: str = "valid") -> DataFrame:
    """One row: total, kept by the validity filter, and dropped."""
    kept = F.count_if(F.col(valid_col) == F.lit(True)) if valid_col in df.columns else F.count(F.lit(1))
    return (df.agg(F.count(F.lit(1)).alias("n_total"), kept.alias("n_valid"))
              .withColumn("n_invalid", F.col("n_total") - F.col("n_valid")))


def null_outside(df: DataFrame, ranges: Mapping[str, tuple] = P.CLEAN_RANGES) -> DataFrame:
    """Null every value outside its inclusive range, all columns in one
    projection. Columns missing from ``df`` are skipped."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    return df.withColumns({c: R.null_outside(c, lo, hi) for c, (lo, hi) in present.items()})


def derive_date(df: DataFrame, ts_col: str = "processing_timestamp", out: str = "date") -> DataFrame:
    """Add the date key text (``yyyy-MM-dd`` in the session zone)."""
    return df.withColumn(out, R.date_key(ts_col))


def ensure_date(df: DataFrame, ts_col: str = "processing_timestamp", out: str = "date") -> DataFrame:
    """Add a DATE key from the timestamp when the column is absent."""
    if out in df.columns:
        return df
    return df.withColumn(out, F.to_date(F.col(ts_col)))


def clean_readings(df: DataFrame, ranges: Mapping[str, tuple] = P.CLEAN_RANGES,
                   ts_col: str = "processing_timestamp") -> DataFrame:
    """Validity filter, fixed 13-column projection, range nulls, date key."""
    kept = filter_valid(df)
    cols = [c for c in S.CLEAN_COLUMNS if c != "processing_timestamp"] + [ts_col]
    cleaned = null_outside(kept.select(*cols), ranges)
    return derive_date(cleaned, ts_col)


def clip_negative(df: DataFrame, column: str = "rain_gauge", floor_value: float = 0.0) -> DataFrame:
    """Negative values become ``floor_value`` (not a flag)."""
    return df.withColumn(column, R.clip_negative(column, floor_value))


def null_profile(df: DataFrame, columns: Iterable[str] = tuple(P.CLEAN_RANGES)) -> DataFrame:
    """One row with the null count of every column, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])


def drop_all_null(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows whose subset columns are all null or NaN."""
    return df.dropna(how="all", subset=list(subset))


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise ValueError listing any required column that is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add literal columns that are absent; present columns are kept."""
    add = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df
