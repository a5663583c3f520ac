"""Z-score anomaly scoring against one-row feature statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.frames import attach_stats
from . import impute


def feature_stats(df: DataFrame, features: Sequence[str] = P.ANOMALY_FEATURES,
                  by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample standard deviation of each feature: `mean_<f>`,
    `stddev_<f>`. One row (or one per ``by`` group), one pass."""
    aggs = ([F.avg(f).alias(f"mean_{f}") for f in features]
            + [F.stddev_samp(f).alias(f"stddev_{f}") for f in features])
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def score_expr(features: Sequence[str] = P.ANOMALY_FEATURES) -> Column:
    """Sum over usable features of |x - mean| / stddev, added in feature
    order from 0.0. A feature counts only with a defined, positive spread;
    NaN is ruled out explicitly (Spark orders NaN above every number, so
    NaN > 0 holds). A null value in a usable feature makes the sum null."""
    terms = []
    for f in features:
        m, sd = f"`mean_{f}`", f"`stddev_{f}`"
        usable = f"{m} IS NOT NULL AND {sd} IS NOT NULL AND NOT isnan({sd}) AND {sd} > 0"
        terms.append(f"CASE WHEN {usable} THEN abs((`{f}` - {m}) / {sd}) ELSE 0D END")
    return F.expr(" + ".join(["0D", *terms]))


def zscore_score(df: DataFrame, features: Sequence[str] = P.ANOMALY_FEATURES,
                 threshold: float = P.ANOMALY_THRESHOLD, stats: DataFrame | None = None,
                 by: Sequence[str] = (), score_col: str = "anomaly_score",
                 flag_col: str = "is_anomaly") -> DataFrame:
    """Add the anomaly score and the flag ``score > threshold``.

    With no usable data (every feature null everywhere) every feature is
    skipped, so the score is 0.0 and the flag false.
    """
    df = df.drop(score_col, flag_col)
    if stats is None:
        stats = feature_stats(df, features, by)
    stat_cols = [f"mean_{f}" for f in features] + [f"stddev_{f}" for f in features]
    stats = stats.select(*by, *stat_cols)
    joined = attach_stats(df, stats, by)
    out = joined.withColumn(score_col, score_expr(features))
    out = out.withColumn(flag_col, F.col(score_col) > F.lit(float(threshold)))
    return out.select(*df.columns, score_col, flag_col)


def anomaly_counts(df: DataFrame, flag_col: str = "is_anomaly") -> DataFrame:
    """One row: flagged and total rows."""
    return df.agg(F.count_if(F.col(flag_col)).alias("n_anomalies"),
                  F.count(F.lit(1)).alias("n_total"))


def reference_stats(df: DataFrame, columns: Sequence[str] = P.IMPUTE_COLUMNS,
                    features: Sequence[str] = P.ANOMALY_FEATURES,
                    by: Sequence[str] = ()) -> DataFrame:
    """Statistics of cleaned readings for ``impute_and_score``: the fill
    values `fill_<c>` and, after filling, `mean_<f>` and `stddev_<f>`; one row,
    or one per ``by`` group."""
    cols = [c for c in columns if c in df.columns]
    moments = impute.column_moments(df, sorted(set(cols) | set(features)), by)
    return impute.imputed_stats(moments, dict(df.dtypes), cols, list(features), by)


def impute_and_score(df: DataFrame, columns: Sequence[str] = P.IMPUTE_COLUMNS,
                     features: Sequence[str] = P.ANOMALY_FEATURES, mode: str = P.AS_WRITTEN,
                     threshold: float = P.ANOMALY_THRESHOLD, by: Sequence[str] = (),
                     score_col: str = "anomaly_score", flag_col: str = "is_anomaly",
                     stats: DataFrame | None = None) -> DataFrame:
    """Mean imputation followed by z-score scoring, with one statistics pass,
    or none when ``stats`` holds the statistics of a reference period (see
    ``reference_stats``): every row is then treated alike, whatever batch it
    comes in.

    Equal to ``zscore_score(impute_mean(df))``: the post-fill feature
    statistics are derived from the pre-fill moments, so the input is read
    twice (statistics, then rows) instead of four times.
    """
    P.check_mode(mode)
    cols = [c for c in columns if c in df.columns]
    feats = list(features)
    types = dict(df.dtypes)
    df = df.drop(score_col, flag_col)
    if stats is None:
        stats = reference_stats(df, cols, feats, by)
    elif not by:
        # one row, also when a stored table holds it
        stats = stats.agg(*[F.first(c).alias(c) for c in stats.columns])
    if mode == P.AS_WRITTEN and cols:
        stats = impute._guard(stats, cols, prefix="fill_")
    joined = attach_stats(df, stats, by)
    out = joined.withColumns(impute.fill_exprs(cols, types, "fill_")).withColumn(
        score_col, score_expr(feats))
    out = out.withColumn(flag_col, F.col(score_col) > F.lit(float(threshold)))
    return out.select(*df.columns, score_col, flag_col)
