"""Column builders for the rule vocabulary: ranges, clips, QC codes, name lists.

All return ``pyspark.sql.Column`` expressions built from Spark built-ins, so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_range(c, lo=None, hi=None) -> Column:
    """Inclusive range test. Open bounds are skipped.

    Two-sided ranges use BETWEEN, one-sided ranges a single comparison. This
    matters for NaN: Spark orders NaN above every number, so ``NaN >= 0`` is
    true while ``NaN BETWEEN 0 AND 15`` is false.
    """
    x = _c(c)
    if lo is not None and hi is not None:
        return x.between(lo, hi)
    if lo is not None:
        return x >= lo
    if hi is not None:
        return x <= hi
    return F.lit(True)


def null_outside(c, lo=None, hi=None) -> Column:
    """The value when inside the range, else null (null stays null)."""
    x = _c(c)
    return F.when(in_range(x, lo, hi), x).otherwise(F.lit(None))


def clip_negative(c, floor_value: float = 0.0) -> Column:
    """Negative values become ``floor_value`` (a DOUBLE); others pass."""
    x = _c(c)
    return F.when(x < 0, F.lit(float(floor_value))).otherwise(x)


def qc_code(fail: Column | None = None, warn: Column | None = None,
            ok: Column | None = None, mode: str = P.AS_WRITTEN) -> Column:
    """Three-level QC code: -2 fail, 0 warning, 1 ok.

    ``as_written``: fail wins, then warn, and everything else is 1; the ok
    condition has no effect. ``corrected``: fail, then ok, then warn, else 1.
    A null measure matches no condition and gets 1 in both modes.
    """
    P.check_mode(mode)
    out = F.lit(P.QC_OK)
    if mode == P.CORRECTED:
        if warn is not None:
            out = F.when(warn, F.lit(P.QC_WARN)).otherwise(out)
        if ok is not None:
            out = F.when(ok, F.lit(P.QC_OK)).otherwise(out)
    else:
        if warn is not None:
            out = F.when(warn, F.lit(P.QC_WARN)).otherwise(out)
    if fail is not None:
        out = F.when(fail, F.lit(P.QC_FAIL)).otherwise(out)
    return out


def names_where(columns: Iterable[str], pred: Mapping[str, Column] | None = None,
                code: int | None = None) -> Column:
    """Array of the column names whose per-row test holds, in listed order.

    Either a fixed ``code`` (name listed when the column equals it) or a
    per-column predicate mapping.
    """
    items = []
    for name in columns:
        cond = pred[name] if pred is not None else (F.col(name) == code)
        items.append(F.when(cond, F.lit(name)))
    return F.array_compact(F.array(*items))


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (floor), as LONG.

    TIMESTAMP_NTZ cannot be cast to a number, so it is read as a session-zone
    timestamp first; for TIMESTAMP this is the plain cast.
    """
    return _c(c).cast("timestamp").cast("long")


def date_key(c, fmt: str = P.DATE_FORMAT) -> Column:
    """Date key text of a timestamp, in the session zone."""
    return F.date_format(_c(c), fmt)
