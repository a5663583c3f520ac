"""DataFrame-level helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_stats(df: DataFrame, stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attach statistics columns to every row of ``df``.

    Without ``by`` the statistics are a *global aggregate* -- exactly one row
    by construction (``DataFrame.agg`` with no grouping) -- broadcast to the
    tasks: a fixed-size broadcast, and a one-row join emits each input row
    once (no pairing of rows). With ``by`` they are one row per key and are
    left-joined on the key; adaptive execution broadcasts them only when their
    measured size is under the threshold.
    """
    if by:
        return df.join(stats, on=list(by), how="left")
    # one row on the right: each left row is emitted exactly once
    return df.crossJoin(F.broadcast(stats))
