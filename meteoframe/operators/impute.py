"""Mean imputation via a one-row (or per-group) statistics table.

The statistics are one aggregate pass with map-side partial aggregation, so
a hot device costs nothing extra. The single stats row is broadcast (its
size is fixed: one row, one column per input), keeping the fill a narrow
projection over the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.frames import attach_stats


def _usable(c: str) -> Column:
    """The value as DOUBLE, or null when missing (null or NaN)."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def column_means(df: DataFrame, columns: Sequence[str] = P.IMPUTE_COLUMNS,
                 by: Sequence[str] = ()) -> DataFrame:
    """Mean of the non-null, non-NaN values of each column (DOUBLE), as
    `mean_<column>`; one row, or one row per ``by`` group."""
    aggs = [F.avg(_usable(c)).alias(f"mean_{c}") for c in columns]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _guard(stats: DataFrame, columns: Sequence[str], prefix: str = "mean_") -> DataFrame:
    """Fail (at run time, lazily) when some column has no usable value while
    another has one -- the surrogate of that column cannot be computed. When
    no column has a usable value the fill is a no-op and passes."""
    nulls = [f"`{prefix}{c}` IS NULL" for c in columns]
    names = ", ".join(f"CASE WHEN `{prefix}{c}` IS NULL THEN '{c}' END" for c in columns)
    cond = (f"CASE WHEN ({' OR '.join(nulls)}) AND NOT ({' AND '.join(nulls)}) "
            f"THEN raise_error(concat('surrogate cannot be computed. All the values in ', "
            f"array_join(array_compact(array({names})), ', '), ' are Null, NaN or missing')) "
            f"ELSE true END")
    return stats.filter(F.expr(cond))


def impute_mean(df: DataFrame, columns: Iterable[str] = P.IMPUTE_COLUMNS,
                mode: str = P.AS_WRITTEN, stats: DataFrame | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """Fill nulls with the column mean; NaN is excluded from the mean and
    left in place. INT columns receive the mean truncated to INT.

    ``stats`` may supply the means (columns `mean_<c>`, plus the ``by``
    keys); otherwise they are computed from ``df`` -- over the whole input
    or per ``by`` group. ``as_written`` fails when a column has no usable
    value while others do; ``corrected`` leaves that column null.
    """
    P.check_mode(mode)
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    types = dict(df.dtypes)
    if stats is None:
        stats = column_means(df, cols, by)
    stats = stats.select(*by, *[F.col(f"mean_{c}") for c in cols])
    if mode == P.AS_WRITTEN:
        stats = _guard(stats, cols)
    joined = attach_stats(df, stats, by)
    return joined.withColumns(fill_exprs(cols, types, "mean_")).select(*df.columns)


def fill_exprs(columns: Sequence[str], types: dict, prefix: str) -> dict:
    """`c` or, when null, its mean cast to the column type (truncating for
    INT columns); NaN is left in place."""
    return {c: F.expr(f"coalesce(`{c}`, CAST(`{prefix}{c}` AS {types[c]}))") for c in columns}


def column_moments(df: DataFrame, columns: Sequence[str] = P.IMPUTE_COLUMNS,
                   by: Sequence[str] = ()) -> DataFrame:
    """One pass of per-column moments: usable count `n_<c>`, mean
    `mean_<c>`, sum of squared deviations `m2_<c>` (of non-null, non-NaN
    values), NaN count `nan_<c>`, and the row count `n_rows`.

    Enough to derive both the imputation means and the statistics of the
    imputed columns (see ``imputed_stats``) without a second scan.
    """
    aggs = [F.expr("count(1) AS n_rows")]
    for c in columns:
        x = f"CAST(`{c}` AS DOUBLE)"
        u = f"CASE WHEN NOT isnan({x}) THEN {x} END"
        aggs += [F.expr(f"count({u}) AS `n_{c}`"), F.expr(f"avg({u}) AS `mean_{c}`"),
                 F.expr(f"var_pop({u}) * count({u}) AS `m2_{c}`"),
                 F.expr(f"count_if(isnan({x})) AS `nan_{c}`")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def imputed_stats(moments: DataFrame, types: dict, columns: Sequence[str],
                  features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Means for the fill plus `mean_<f>` / `stddev_<f>` (sample) of each
    feature *after* the fill, derived from ``column_moments``.

    After filling z nulls with f (the mean, truncated for INT columns) the
    n usable values with mean m and squared deviations M2 become n + z
    values with mean m' = (n m + z f) / (n + z) and squared deviations
    M2 + n (m - m')^2 + z (f - m')^2. A NaN anywhere makes both NaN, and
    fewer than two values give a null deviation, as direct aggregation does.
    """
    out = [f"`{k}`" for k in by] + [f"`mean_{c}` AS `fill_{c}`" for c in columns]
    for f in features:
        n, m, m2, k = f"`n_{f}`", f"`mean_{f}`", f"`m2_{f}`", f"`nan_{f}`"
        if f in columns:
            fill = f"CAST(CAST({m} AS {types[f]}) AS DOUBLE)"
            filled = f"(CASE WHEN {m} IS NOT NULL THEN n_rows - {n} - {k} ELSE 0 END)"
        else:
            fill, filled = "0D", "0"
        cnt = f"({n} + {filled})"
        mean2 = f"(({n} * coalesce({m}, 0D) + {filled} * coalesce({fill}, 0D)) / {cnt})"
        m2b = (f"(coalesce({m2}, 0D) + {n} * pow(coalesce({m}, 0D) - {mean2}, 2)"
               f" + {filled} * pow(coalesce({fill}, 0D) - {mean2}, 2))")
        out.append(f"CASE WHEN {k} > 0 THEN double('NaN') WHEN {cnt} > 0 THEN {mean2} END "
                   f"AS `mean_{f}`")
        out.append(f"CASE WHEN {k} > 0 AND {cnt} + {k} > 1 THEN double('NaN') "
                   f"WHEN {cnt} > 1 THEN sqrt({m2b} / ({cnt} - 1)) END AS `stddev_{f}`")
    return moments.selectExpr(*out)
