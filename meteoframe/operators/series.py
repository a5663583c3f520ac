"""Per-device series operators: de-duplication and previous-row features.

Scale design
------------
A plain ``Window.partitionBy(device).orderBy(ts)`` sorts a device's whole
history in one task, so one busy device (or a third of all rows under one
key) becomes one straggler. Here:

* De-duplication is a hash aggregate whose survivor is chosen by ``min`` of
  a struct. Map-side partial aggregation collapses copies inside each map
  task, so a hot group of copies never reaches one reducer whole.
* Previous-row values are computed per (device, [day,] time bucket). Each
  bucket's first row takes its predecessor from a *carry* row: the last row
  of the previous non-empty bucket, found on a bucket-level table (one row
  per device-bucket, so its size is bounded by time span / bucket width,
  not by data volume). Carry rows are unioned into the readings and ordered
  first in their bucket, so a single window pass does lag and carry with no
  join and one shuffle. Per-group totals (e.g. daily counts) ride on the
  same carry rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import rules as R


def dedup(df: DataFrame, keys: Sequence[str] = ("device_id", "processing_timestamp"),
          order: Sequence[str] = ("reading_id",)) -> DataFrame:
    """One row per key (null keys compare equal). The survivor has the
    smallest ``order`` values (nulls last), then the smallest remaining
    columns, so the result is deterministic."""
    keys, order = list(keys), [o for o in order if o not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[f for i, o in enumerate(order)
                        for f in (F.col(o).isNull().alias(f"_null{i}"), F.col(o).alias(o))],
                      *[F.col(c).alias(c) for c in rest])
    out = df.groupBy(*keys).agg(F.min(packed).alias("_row"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def parse_and_dedup(df: DataFrame, ts_col: str = "processing_timestamp",
                    key: str = "device_id") -> DataFrame:
    """Parse the timestamp when it is text, then de-duplicate on
    (device, timestamp)."""
    if dict(df.dtypes).get(ts_col) == "string":
        df = df.withColumn(ts_col, F.to_timestamp(F.col(ts_col)))
    # the time first: rows are ordered by it alone but for ties
    return dedup(df, (ts_col, key))


def with_previous(df: DataFrame, columns: Sequence[str],
                  ts_col: str = "processing_timestamp",
                  partition: Sequence[str] = ("device_id",),
                  group: Sequence[str] = (),
                  counts: Mapping[str, str] | None = None,
                  sums: Mapping[str, str] | None = None,
                  bucket_seconds: int | Sequence[int] = P.LAG_BUCKET_SECONDS,
                  prefix: str = "prev_", context: DataFrame | None = None) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the previous row of the same
    ``partition`` in timestamp order (null on the first row), equal to
    ``lag(c) over (partition by partition order by ts)``.

    ``context`` rows (same key, group, timestamp and value columns) are
    earlier readings that take part in the ordering -- e.g. each device's
    last reading of the previous micro-batch -- but are neither returned nor
    counted. On equal timestamps a context row sorts first.

    ``bucket_seconds`` may be a sequence of widths, finest first: the
    bucket-level table is then processed by this same algorithm with the
    next width, so every window partition stays bounded (readings per
    device-bucket, buckets per coarser bucket, ..., and coarsest buckets per
    device) even for a device emitting at very high rates.

    ``group`` columns (e.g. the date key) further split the work; they must
    be non-decreasing in time within a partition, as a date derived from
    the timestamp is. ``counts`` / ``sums`` map output names to columns
    whose non-null count / sum over (partition + group) is attached to each
    row; like a left join on those keys, they are null when a key is null.
    """
    counts, sums = dict(counts or {}), dict(sums or {})
    pkeys, gkeys = list(partition), list(group)
    cols = list(columns)
    widths = ((int(bucket_seconds),) if isinstance(bucket_seconds, (int, float))
              else tuple(int(w) for w in bucket_seconds))
    width, coarser = widths[0], widths[1:]
    sec = R.epoch_seconds(ts_col)
    rows = df.withColumns({"_bkt": F.floor(sec / F.lit(width)),
                           "_kind": F.lit(1), "_ctx": F.lit(False)})
    if context is not None:
        ctx = context.select(*pkeys, *gkeys, ts_col, *[c for c in cols if c != ts_col])
        ctx = ctx.withColumns({"_bkt": F.floor(R.epoch_seconds(ts_col) / F.lit(width)),
                               "_kind": F.lit(1), "_ctx": F.lit(True)})
        rows = rows.unionByName(ctx, allowMissingColumns=True)
    own = ~F.col("_ctx")

    # Bucket-level table: one row per (partition, group, bucket).
    # The bucket first: sorts compare it before the (few) keys.
    gb = ["_bkt"] + pkeys + gkeys
    part_aggs = ([F.count(F.when(own, F.col(c))).alias(f"_cnt_{n}") for n, c in counts.items()]
                 + [F.sum(F.when(own, F.col(c))).alias(f"_sum_{n}") for n, c in sums.items()])
    # Last row of each bucket, one max_by per column over a LONG ordering
    # key: fixed-width buffers keep this a hash aggregate (a struct buffer
    # would force a sort of every row). A null time sorts lowest, as in the
    # window; on equal times an input row ranks after a context row, as in
    # the window below. After de-duplication there are no other ties.
    okey = F.coalesce(F.unix_micros(F.col(ts_col).cast("timestamp")) * 2
                      + F.when(own, F.lit(1)).otherwise(F.lit(0)),
                      F.lit(-(2 ** 63)).cast("long"))
    buckets = rows.groupBy(*gb).agg(
        F.min(ts_col).alias("_t0"),
        *[F.max_by(F.col(c), okey).alias(f"_last_{c}") for c in cols],
        *part_aggs)
    if coarser:
        # Previous bucket's last row = the same problem one level up: buckets
        # ordered by their first time (buckets are disjoint in time).
        lasts = [f"_last_{c}" for c in cols]
        up = with_previous(buckets.withColumnRenamed("_bkt", "_bkt_up"), lasts, "_t0", pkeys,
                           bucket_seconds=coarser, prefix="_up")
        buckets = up.withColumnRenamed("_bkt_up", "_bkt")
        carry_cols = {"_carry": F.struct(*[F.col(f"_up_last_{c}").alias(c) for c in cols])}
    else:
        order = Window.partitionBy(*pkeys).orderBy(F.col("_bkt").asc_nulls_first(),
                                                   F.col("_t0").asc_nulls_first())
        last = F.struct(*[F.col(f"_last_{c}").alias(c) for c in cols])
        carry_cols = {"_carry": F.lag(last).over(order)}
    carried = buckets.withColumns(carry_cols)
    if part_aggs:
        names = list(counts) + list(sums)
        src = {n: f"_cnt_{n}" for n in counts} | {n: f"_sum_{n}" for n in sums}
        if gkeys:
            # Totals over the buckets of one group (e.g. the 24 hourly buckets
            # of a device-day): a window on the same bucket table, so the
            # bucket aggregate (and the shuffles below it) run once. Like a
            # left join of the readings, a null key gets no totals.
            whole = Window.partitionBy(*pkeys, *gkeys)
            known = F.lit(True)
            for k in pkeys + gkeys:
                known = known & F.col(k).isNotNull()
            carried = carried.withColumns(
                {n: F.when(known, F.sum(src[n]).over(whole)) for n in names})
        else:
            # No group key: a device's buckets are not bounded, so aggregate
            # (partially) and join back instead of a window.
            totals = buckets.groupBy(*pkeys).agg(*[F.sum(src[n]).alias(n) for n in names])
            carried = carried.join(totals, on=pkeys, how="left")
    carry = carried.select(
        *gb, F.lit(0).alias("_kind"), F.lit(False).alias("_ctx"),
        *[F.col(f"_carry.{c}").alias(c) for c in cols],
        *[F.col(n) for n in list(counts) + list(sums)])

    # One window pass: carry row first in each bucket, then readings by time.
    both = rows.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*gb).orderBy(F.col("_kind"), F.col(ts_col).asc_nulls_first(),
                                        F.col("_ctx").desc())
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag(F.struct(*[F.col(c).alias(c) for c in cols])).over(w)
    adds = {"_prev": prev}
    for n in list(counts) + list(sums):
        adds[n] = F.last(F.col(n), ignorenulls=True).over(running)
    out = both.withColumns(adds).filter((F.col("_kind") == 1) & own)
    return out.select(*df.columns,
                      *[F.col(f"_prev.{c}").alias(prefix + c) for c in cols],
                      *[F.col(n) for n in list(counts) + list(sums)])


def time_diff(df: DataFrame, ts_col: str = "processing_timestamp",
              key: str = "device_id", out: str = "time_diff",
              bucket_seconds: int | Sequence[int] = P.LAG_BUCKET_SECONDS) -> DataFrame:
    """Minutes since the device's previous reading, from whole seconds
    (null on a device's first reading)."""
    prev = with_previous(df, [ts_col], ts_col, (key,), bucket_seconds=bucket_seconds,
                         prefix="_prev_")
    diff = (R.epoch_seconds(ts_col) - R.epoch_seconds(f"_prev_{ts_col}")) / F.lit(60.0)
    return prev.withColumn(out, diff).drop(f"_prev_{ts_col}")


def step(df: DataFrame, column: str = "air_temperature", out: str = "tair_step",
         ts_col: str = "processing_timestamp", key: str = "device_id",
         bucket_seconds: int | Sequence[int] = P.LAG_BUCKET_SECONDS) -> DataFrame:
    """Change of ``column`` since the device's previous reading."""
    prev = with_previous(df, [column], ts_col, (key,), bucket_seconds=bucket_seconds,
                         prefix="_prev_")
    return prev.withColumn(out, F.col(column) - F.col(f"_prev_{column}")).drop(f"_prev_{column}")


def daily_metrics_join(df: DataFrame, keys: Sequence[str] = ("device_id", "date"),
                       ts_col: str = "processing_timestamp", rain_col: str = "rain_gauge",
                       slots_per_day: float = P.SLOTS_PER_DAY) -> DataFrame:
    """Attach per (device, day) availability and rain total to every row,
    as a left join would (null metrics on null keys).

    Relational form: a partially aggregated metrics table joined back on the
    keys. Adaptive execution broadcasts the metrics when their measured size
    is under the threshold and otherwise runs a sort-merge join with
    skewed-partition splitting.
    """
    from .aggregate import daily_metrics
    m = daily_metrics(df, keys, ts_col, rain_col, slots_per_day)
    return df.join(m, on=list(keys), how="left")
