"""Registered queries: one per operator of the inventory, each over the whole
derived readings table (or another driver table), with its DuckDB oracle.

Floating results that depend on summation order (means, standard
deviations, scores) are rounded to 6 decimals in both the query and the
oracle; the library operators themselves return full precision.

Families (in file order): sources and codec (json_*, flatten_reading,
parse_iso_ts, explode_envelope, raw_*, derived_readings); cleaning
(filter_valid ... drop_all_null); imputation (impute_mean*, column_means);
anomaly (feature_stats, zscore_*, anomaly_counts); aggregation (daily_*,
gate_stats, quality_gate, medians, daily_metrics*, slot_availability,
latest_daily_topk); series (dedup_device_ts, time_diff, tair_step); QC
(qc_* per check in both modes, qc_collect*, qc_level1*); the batch table job
(batch_tables_daily). Streaming queries live in ``streaming/queries.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.frames import attach_stats
from ..operators import aggregate, anomaly, clean, impute, qc, quality, running, series
from ..session import apply_semantics
from ..sources import envelope
from ..sources.tables import load_readings, load_table, readings_from_events
from . import oracle as O
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def rnd6(c) -> "F.Column":
    """Round to 6 decimals through DECIMAL(38,10) (see ``oracle.rnd6``)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(x), x).otherwise(F.round(x.cast("decimal(38,10)"), 6).cast("double"))


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: rnd6(c) for c in cols})


def _readings(spark, sf_dir):
    return load_readings(spark, sf_dir)


def _cleaned(spark, sf_dir):
    return pipeline.cleaned(_readings(spark, sf_dir))


def _imputed(spark, sf_dir, mode=P.AS_WRITTEN):
    return pipeline.imputed(_readings(spark, sf_dir), mode)


def _scored(spark, sf_dir):
    return pipeline.scored(_readings(spark, sf_dir))


def _daily(spark, sf_dir):
    return pipeline.daily(_readings(spark, sf_dir))


FLAT = ("reading_id, device_id, valid, uv_index, rain_gauge, wind_speed, air_humidity, "
        "peak_wind_gust, air_temperature, light_intensity, rain_accumulation, "
        "barometric_pressure, wind_direction_sensor")
CLEAN = ("reading_id, device_id, uv_index, rain_gauge, wind_speed, air_humidity, peak_wind_gust, "
         "air_temperature, light_intensity, rain_accumulation, barometric_pressure, "
         "wind_direction_sensor, processing_timestamp, date")
CREATED_AT_SQL = "strftime(processing_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"

# ------------------------------------------------------------------ sources


@register("json_decode_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_decode_props(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@register("json_decode_envelope", O.sql(["readings"], f"""
SELECT 'Request successful' AS message, TRUE AS success, reading_id, device_id,
 {CREATED_AT_SQL} AS created_at, valid FROM readings"""))
def q_json_decode_envelope(spark, sf_dir):
    wire = envelope.encode_envelope(_readings(spark, sf_dir))
    dec = envelope.decode_envelope(wire, "value", full=True)
    return dec.select("message", "success", "reading_id", "device_id", "created_at",
                      F.col("reading.valid").alias("valid"))


@register("flatten_reading", O.sql(["readings"], f"""
SELECT {FLAT}, date_trunc('millisecond', processing_timestamp) AS processing_timestamp
FROM readings"""))
def q_flatten_reading(spark, sf_dir):
    wire = envelope.encode_envelope(_readings(spark, sf_dir))
    return envelope.decode_readings(wire, "value")


@register("parse_iso_ts", f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at,
 date_trunc('millisecond', ts) AS processing_timestamp FROM events""")
def q_parse_iso_ts(spark, sf_dir):
    apply_semantics(spark)
    ev = load_table(spark, sf_dir, "events").select(
        "event_id", F.date_format(F.col("ts").cast("timestamp"), P.CREATED_AT_FORMAT).alias("created_at"))
    return ev.withColumn("processing_timestamp", envelope.parse_created_at("created_at"))


@register("explode_envelope", O.sql(["readings"], f"""
SELECT 'Request successful' AS message, TRUE AS success, reading_id, device_id,
 {CREATED_AT_SQL} AS created_at, air_temperature FROM readings"""))
def q_explode_envelope(spark, sf_dir):
    apply_semantics(spark)
    ev = load_table(spark, sf_dir, "events")
    # API pages of at most 64 events (event_id is unique): a bounded list.
    flat = readings_from_events(ev, keep_event_id=True)
    pages = envelope.encode_pages(flat.withColumn("page", F.floor(F.col("event_id") / 64)), "page")
    ex = envelope.explode_pages(pages)
    return ex.select("message", "success", F.col("data.reading_id").alias("reading_id"),
                     F.col("data.device_id").alias("device_id"),
                     F.col("data.created_at").alias("created_at"),
                     F.col("data.reading.air_temperature").alias("air_temperature"))


_RAW_FIELDS = [c.strip() for c in FLAT.split(",")]


@register("raw_json_sink", O.sql(["readings"], "SELECT " + ", ".join(
    f"{O.r6(c, c)}" if c in ("peak_wind_gust", "air_temperature") else c for c in _RAW_FIELDS)
    + ", date_trunc('millisecond', processing_timestamp) AS processing_timestamp FROM readings"))
def q_raw_json_sink(spark, sf_dir):
    """Raw-table rows: the typed flat reading as JSON text (null fields
    omitted); the text is parsed again here so that every field is compared."""
    from ..schemas import FLAT_READING
    from ..sinks import writers
    raw = writers.raw_json(_readings(spark, sf_dir))
    back = raw.select(F.from_json("data", FLAT_READING).alias("r")).select("r.*")
    return r6(back.withColumn("processing_timestamp", F.date_trunc("millisecond", "processing_timestamp")),
              "peak_wind_gust", "air_temperature")


@register("raw_json_fields", O.sql(["readings"], "SELECT reading_id, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'absent' ELSE 'present' END AS {c}" for c in _RAW_FIELDS[1:])
    + " FROM readings"))
def q_raw_json_fields(spark, sf_dir):
    """Which fields a raw row's text holds: null ones are left out."""
    from ..sinks import writers
    raw = writers.raw_json(_readings(spark, sf_dir))
    held = [F.when(F.get_json_object("data", f"$.{c}").isNull(), "absent").otherwise("present").alias(c)
            for c in _RAW_FIELDS[1:]]
    return raw.select(F.get_json_object("data", "$.reading_id").alias("reading_id"), *held)


@register("derived_readings", O.sql(["readings"], f"SELECT {FLAT}, processing_timestamp FROM readings"))
def q_derived_readings(spark, sf_dir):
    """The readings every other query starts from, derived from `events`."""
    return _readings(spark, sf_dir)


@register("raw_count", O.sql(["readings"], "SELECT count(*) AS n_rows FROM readings"))
def q_raw_count(spark, sf_dir):
    return _readings(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


# ----------------------------------------------------------------- cleaning


@register("filter_valid", O.sql(["readings"],
                                "SELECT reading_id, device_id, valid FROM readings WHERE valid = TRUE"))
def q_filter_valid(spark, sf_dir):
    return clean.filter_valid(_readings(spark, sf_dir)).select("reading_id", "device_id", "valid")


@register("valid_counts", O.sql(["readings"], """
SELECT count(*) AS n_total, CAST(count_if(valid = TRUE) AS BIGINT) AS n_valid,
 CAST(count(*) - count_if(valid = TRUE) AS BIGINT) AS n_invalid FROM readings"""))
def q_valid_counts(spark, sf_dir):
    return clean.valid_counts(_readings(spark, sf_dir))


@register("clean_readings", O.sql(["cleaned"], f"SELECT {CLEAN} FROM cleaned"))
def q_clean_readings(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@register("derive_date", O.sql(["readings"], """
SELECT reading_id, processing_timestamp, strftime(processing_timestamp, '%Y-%m-%d') AS date
FROM readings"""))
def q_derive_date(spark, sf_dir):
    df = _readings(spark, sf_dir).select("reading_id", "processing_timestamp")
    return clean.derive_date(df)


@register("clip_negative", O.sql(["readings"], """
SELECT reading_id, CASE WHEN rain_gauge < 0 THEN CAST(0.0 AS DOUBLE) ELSE rain_gauge END AS rain_gauge
FROM readings"""))
def q_clip_negative(spark, sf_dir):
    return clean.clip_negative(_readings(spark, sf_dir).select("reading_id", "rain_gauge"))


_NULL_COLS = list(P.CLEAN_RANGES)


@register("null_profile", O.sql(["cleaned"], "SELECT " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls_{c}" for c in _NULL_COLS) + " FROM cleaned"))
def q_null_profile(spark, sf_dir):
    return clean.null_profile(_cleaned(spark, sf_dir), _NULL_COLS)


@register("drop_all_null", O.sql(["cleaned"], """
SELECT reading_id, uv_index, air_temperature FROM cleaned
WHERE NOT ((uv_index IS NULL OR isnan(uv_index)) AND (air_temperature IS NULL OR isnan(air_temperature)))"""))
def q_drop_all_null(spark, sf_dir):
    df = _cleaned(spark, sf_dir).select("reading_id", "uv_index", "air_temperature")
    return clean.drop_all_null(df, ["uv_index", "air_temperature"])


# --------------------------------------------------------------- imputation

_IMP_DBL = ["uv_index", "wind_speed", "peak_wind_gust", "air_temperature", "rain_accumulation"]


def _imputed_sql(src: str) -> str:
    cols = []
    for c in CLEAN.split(", "):
        cols.append(O.r6(c, c) if c in _IMP_DBL else c)
    return O.sql([src], f"SELECT {', '.join(cols)} FROM {src}")


@register("impute_mean", _imputed_sql("imputed"))
def q_impute_mean(spark, sf_dir):
    return r6(_imputed(spark, sf_dir), *_IMP_DBL)


@register("impute_mean_corrected", _imputed_sql("imputed"))
def q_impute_mean_corrected(spark, sf_dir):
    return r6(_imputed(spark, sf_dir, P.CORRECTED), *_IMP_DBL)


@register("column_means", O.sql(["means"], "SELECT " + ", ".join(
    O.r6(f"mean_{c}", f"mean_{c}") for c in O.IMPUTE_COLS) + " FROM means"))
def q_column_means(spark, sf_dir):
    m = impute.column_means(_cleaned(spark, sf_dir))
    return r6(m, *m.columns)


@register("impute_mean_by_device", _imputed_sql("imputed_dev"))
def q_impute_mean_by_device(spark, sf_dir):
    d = impute.impute_mean(_cleaned(spark, sf_dir), mode=P.CORRECTED, by=("device_id",))
    return r6(d, *_IMP_DBL)


@register("impute_void_column_corrected", O.sql(["imputed"], "SELECT " + ", ".join(
    "CAST(NULL AS INTEGER) AS light_intensity" if c == "light_intensity" else O.r6(c, c) if c in _IMP_DBL else c
    for c in CLEAN.split(", ")) + " FROM imputed"))
def q_impute_void_column_corrected(spark, sf_dir):
    """A column without any value, where the modes part: corrected leaves it
    null and fills the others (as written stops, see the tests)."""
    void = _cleaned(spark, sf_dir).withColumn("light_intensity", F.lit(None).cast("int"))
    return r6(impute.impute_mean(void, mode=P.CORRECTED), *_IMP_DBL)


# ------------------------------------------------------------------ anomaly


@register("feature_stats", O.sql(["zstats"], "SELECT " + ", ".join(
    [O.r6(f"mean_{f}", f"mean_{f}") for f in O.FEATURES]
    + [O.r6(f"stddev_{f}", f"stddev_{f}") for f in O.FEATURES]) + " FROM zstats"))
def q_feature_stats(spark, sf_dir):
    s = anomaly.feature_stats(_imputed(spark, sf_dir))
    return r6(s, *s.columns)


@register("zscore_score", O.sql(["scored"],
                                "SELECT reading_id, (CASE WHEN isnan(CAST(anomaly_score AS DOUBLE)) THEN CAST(anomaly_score AS DOUBLE) ELSE CAST(round(CAST(CAST(anomaly_score AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS anomaly_score FROM scored"))
def q_zscore_score(spark, sf_dir):
    return r6(_scored(spark, sf_dir).select("reading_id", "anomaly_score"), "anomaly_score")


@register("zscore_by_device", O.sql(["scored_dev"], """
SELECT reading_id, (CASE WHEN isnan(CAST(anomaly_score AS DOUBLE)) THEN CAST(anomaly_score AS DOUBLE) ELSE CAST(round(CAST(CAST(anomaly_score AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS anomaly_score, anomaly_score > 10.0 AS is_anomaly
FROM scored_dev"""))
def q_zscore_by_device(spark, sf_dir):
    d = anomaly.impute_and_score(_cleaned(spark, sf_dir), mode=P.CORRECTED, by=("device_id",))
    return r6(d.select("reading_id", "anomaly_score", "is_anomaly"), "anomaly_score")


@register("zscore_flag", O.sql(["flagged"], "SELECT reading_id, is_anomaly FROM flagged"))
def q_zscore_flag(spark, sf_dir):
    return _scored(spark, sf_dir).select("reading_id", "is_anomaly")


@register("anomaly_counts", O.sql(["flagged"], """
SELECT CAST(count_if(is_anomaly) AS BIGINT) AS n_anomalies, count(*) AS n_total FROM flagged"""))
def q_anomaly_counts(spark, sf_dir):
    return anomaly.anomaly_counts(_scored(spark, sf_dir))


# -------------------------------------------------------------- aggregation


DAILY_SQL = O.sql(["daily"], f"SELECT {O.DAILY_COLS} FROM daily")


def rounded_daily(daily: DataFrame) -> DataFrame:
    return r6(daily, "maxtemp_c", "mintemp_c", "avgtemp_c", "anomaly_score")


@register("daily_summary", DAILY_SQL)
def q_daily_summary(spark, sf_dir):
    return rounded_daily(_daily(spark, sf_dir))


def _daily_clean(spark, sf_dir):
    return aggregate.daily_summary(_cleaned(spark, sf_dir))


@register("daily_temp", O.sql(["daily_clean"], """
SELECT device_id, date, maxtemp_c, mintemp_c, (CASE WHEN isnan(CAST(avgtemp_c AS DOUBLE)) THEN CAST(avgtemp_c AS DOUBLE) ELSE CAST(round(CAST(CAST(avgtemp_c AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS avgtemp_c FROM daily_clean"""))
def q_daily_temp(spark, sf_dir):
    d = _daily_clean(spark, sf_dir).select("device_id", "date", "maxtemp_c", "mintemp_c", "avgtemp_c")
    return r6(d, "avgtemp_c")


@register("daily_wind_kph", O.sql(["daily_clean"], "SELECT device_id, date, maxwind_kph FROM daily_clean"))
def q_daily_wind_kph(spark, sf_dir):
    return _daily_clean(spark, sf_dir).select("device_id", "date", "maxwind_kph")


@register("daily_rain", O.sql(["daily_clean"], """
SELECT device_id, date, totalprecip_mm, daily_will_it_rain FROM daily_clean"""))
def q_daily_rain(spark, sf_dir):
    return _daily_clean(spark, sf_dir).select("device_id", "date", "totalprecip_mm", "daily_will_it_rain")


@register("daily_humidity_pressure", O.sql(["daily_clean"], """
SELECT device_id, date, avghumidity, daily_chance_of_rain, date_epoch, processing_timestamp
FROM daily_clean"""))
def q_daily_humidity_pressure(spark, sf_dir):
    return _daily_clean(spark, sf_dir).select("device_id", "date", "avghumidity",
                                              "daily_chance_of_rain", "date_epoch",
                                              "processing_timestamp")


@register("daily_anomaly", O.sql(["daily"], """
SELECT device_id, date, (CASE WHEN isnan(CAST(anomaly_score AS DOUBLE)) THEN CAST(anomaly_score AS DOUBLE) ELSE CAST(round(CAST(CAST(anomaly_score AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS anomaly_score, is_anomaly FROM daily"""))
def q_daily_anomaly(spark, sf_dir):
    d = _daily(spark, sf_dir).select("device_id", "date", "anomaly_score", "is_anomaly")
    return r6(d, "anomaly_score")


@register("daily_defaults", O.sql(["daily_clean"], """
SELECT device_id, date, anomaly_score, is_anomaly FROM daily_clean"""))
def q_daily_defaults(spark, sf_dir):
    return _daily_clean(spark, sf_dir).select("device_id", "date", "anomaly_score", "is_anomaly")


@register("coerce_write_types", O.sql(["daily"], """
SELECT device_id, CAST(date AS DATE) AS date, CAST(processing_timestamp AS TIMESTAMP) AS processing_timestamp,
 date_epoch FROM daily"""))
def q_coerce_write_types(spark, sf_dir):
    from ..sinks import writers
    d = writers.coerce_write_types(_daily(spark, sf_dir))
    return d.select("device_id", "date", "processing_timestamp", "date_epoch")


@register("gate_stats", O.sql(["daily"], """
SELECT (CASE WHEN isnan(CAST(min(mintemp_c) AS DOUBLE)) THEN CAST(min(mintemp_c) AS DOUBLE) ELSE CAST(round(CAST(CAST(min(mintemp_c) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS min_temp, (CASE WHEN isnan(CAST(max(maxtemp_c) AS DOUBLE)) THEN CAST(max(maxtemp_c) AS DOUBLE) ELSE CAST(round(CAST(CAST(max(maxtemp_c) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS max_temp,
 (CASE WHEN isnan(CAST(avg(avghumidity) AS DOUBLE)) THEN CAST(avg(avghumidity) AS DOUBLE) ELSE CAST(round(CAST(CAST(avg(avghumidity) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS avg_humidity FROM daily"""))
def q_gate_stats(spark, sf_dir):
    return r6(aggregate.gate_stats(_daily(spark, sf_dir)), "min_temp", "max_temp", "avg_humidity")


@register("quality_gate", O.sql(["daily"], """
SELECT * FROM (
 SELECT 'non_empty' AS rule, count(*) > 0 AS passed, CAST(count(*) AS DOUBLE) AS observed FROM daily
 UNION ALL SELECT 'device_id_not_null', count_if(device_id IS NULL) = 0, CAST(count_if(device_id IS NULL) AS DOUBLE) FROM daily
 UNION ALL SELECT 'date_not_null', count_if(date IS NULL) = 0, CAST(count_if(date IS NULL) AS DOUBLE) FROM daily
 UNION ALL SELECT 'min_temp_present', coalesce(min(mintemp_c) IS NOT NULL, FALSE), (CASE WHEN isnan(CAST(min(mintemp_c) AS DOUBLE)) THEN CAST(min(mintemp_c) AS DOUBLE) ELSE CAST(round(CAST(CAST(min(mintemp_c) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) FROM daily
 UNION ALL SELECT 'max_temp_present', coalesce(max(maxtemp_c) IS NOT NULL, FALSE), (CASE WHEN isnan(CAST(max(maxtemp_c) AS DOUBLE)) THEN CAST(max(maxtemp_c) AS DOUBLE) ELSE CAST(round(CAST(CAST(max(maxtemp_c) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) FROM daily
 UNION ALL SELECT 'min_le_max', coalesce(min(mintemp_c) <= max(maxtemp_c), FALSE), (CASE WHEN isnan(CAST(max(maxtemp_c) - min(mintemp_c) AS DOUBLE)) THEN CAST(max(maxtemp_c) - min(mintemp_c) AS DOUBLE) ELSE CAST(round(CAST(CAST(max(maxtemp_c) - min(mintemp_c) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) FROM daily
 UNION ALL SELECT 'avg_humidity_in_range', coalesce(avg(avghumidity) BETWEEN 0 AND 100, FALSE), (CASE WHEN isnan(CAST(avg(avghumidity) AS DOUBLE)) THEN CAST(avg(avghumidity) AS DOUBLE) ELSE CAST(round(CAST(CAST(avg(avghumidity) AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) FROM daily
 UNION ALL SELECT 'all', coalesce(count(*) > 0 AND count_if(device_id IS NULL) = 0 AND count_if(date IS NULL) = 0
   AND min(mintemp_c) IS NOT NULL AND max(maxtemp_c) IS NOT NULL AND min(mintemp_c) <= max(maxtemp_c)
   AND avg(avghumidity) BETWEEN 0 AND 100, FALSE), CAST(NULL AS DOUBLE) FROM daily)"""))
def q_quality_gate(spark, sf_dir):
    rep = quality.quality_report(_daily(spark, sf_dir))
    return r6(rep, "observed")


#: What an approximate median has to keep, checked on the oracle's side for the
#: exact one: n values, at most half of them (and the error) on either side.
MEDIAN_SQL = O.sql(["cleaned"], """
SELECT count(*) AS n, max(x) >= any_value(m) AND min(x) <= any_value(m) AS observed,
 avg(CASE WHEN x < m THEN 1.0 ELSE 0.0 END) <= 0.51 AND avg(CASE WHEN x > m THEN 1.0 ELSE 0.0 END) <= 0.51 AS within_error
FROM (SELECT barometric_pressure AS x, quantile_disc(barometric_pressure, 0.5) OVER () AS m
      FROM cleaned WHERE barometric_pressure IS NOT NULL) AS v""")


def _rank_bounds(rows: DataFrame, median: DataFrame) -> DataFrame:
    """n values, whether ``median_x`` is one of them, and whether the shares of
    values below and above it keep within the stated rank error of a half."""
    m = F.col("median_x")
    share = attach_stats(rows, median).agg(
        F.count("x").alias("n"), F.avg((F.col("x") < m).cast("double")).alias("below"),
        F.avg((F.col("x") > m).cast("double")).alias("above"), F.bool_or(F.col("x") == m).alias("observed"))
    most = 0.5 + P.MEDIAN_RELATIVE_ERROR
    return share.select("n", "observed", ((F.col("below") <= most) & (F.col("above") <= most)).alias("within_error"))


def _pressures(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("reading_id", F.col("barometric_pressure").alias("x")).filter("x IS NOT NULL")


@register("approx_median", MEDIAN_SQL)
def q_approx_median(spark, sf_dir):
    """The approximate median of all rows, held against the rows."""
    rows = _pressures(spark, sf_dir)
    return _rank_bounds(rows, aggregate.approx_median(rows, "x"))


@register("median_of_sketches", MEDIAN_SQL)
def q_median_of_sketches(spark, sf_dir):
    """The median of sixteen batches' sketches, merged, held against the rows."""
    rows = _pressures(spark, sf_dir)
    sketches = rows.groupBy(F.pmod(F.xxhash64("reading_id"), F.lit(16)).alias("batch")).agg(
        aggregate.quantile_sketch("x").alias("sketch"))
    return _rank_bounds(rows, aggregate.median_of_sketches(sketches, "sketch", "x"))


@register("median_is_pa", O.sql(["cleaned"], """
SELECT median(barometric_pressure) > 2000 AS median_is_pa FROM cleaned"""))
def q_median_is_pa(spark, sf_dir):
    """The unit decision taken from the approximate median (Pa when above
    2000); compared with the exact median's decision."""
    m = aggregate.approx_median(_cleaned(spark, sf_dir), "barometric_pressure")
    return m.select((F.col("median_barometric_pressure") > P.PA_MEDIAN_SWITCH).alias("median_is_pa"))


@register("exact_median", O.sql(["cleaned"], """
SELECT CAST(median(barometric_pressure) AS DOUBLE) AS median_barometric_pressure FROM cleaned"""))
def q_exact_median(spark, sf_dir):
    return aggregate.exact_median(_cleaned(spark, sf_dir), "barometric_pressure")


@register("daily_metrics", O.sql(["daily_metrics_clean"], "SELECT * FROM daily_metrics_clean"))
def q_daily_metrics(spark, sf_dir):
    return aggregate.daily_metrics(_cleaned(spark, sf_dir))


@register("daily_metrics_join", O.sql(["cleaned", "daily_metrics_clean"], """
SELECT c.reading_id, c.device_id, c.date, m.daily_valid_frac, m.daily_rain_mm
FROM cleaned c LEFT JOIN daily_metrics_clean m ON c.device_id = m.device_id AND c.date = m.date"""))
def q_daily_metrics_join(spark, sf_dir):
    j = series.daily_metrics_join(_cleaned(spark, sf_dir))
    return j.select("reading_id", "device_id", "date", "daily_valid_frac", "daily_rain_mm")


@register("slot_availability", O.sql(["cleaned"], """
SELECT device_id, time_bucket(INTERVAL 15 minutes, processing_timestamp) AS slot_start,
 time_bucket(INTERVAL 15 minutes, processing_timestamp) + INTERVAL 15 minutes AS slot_end,
 count(*) AS n_readings FROM cleaned GROUP BY ALL"""))
def q_slot_availability(spark, sf_dir):
    return aggregate.slot_availability(_cleaned(spark, sf_dir))


SLOT_CALENDAR_SQL = O.sql(["cleaned"], """
SELECT c.device_id, c.slot_start, c.slot_start + INTERVAL 15 minutes AS slot_end, coalesce(n.n, 0) AS n_readings
FROM (SELECT device_id, unnest(generate_series(min(slot), max(slot), INTERVAL 15 minutes)) AS slot_start
      FROM (SELECT device_id, time_bucket(INTERVAL 15 minutes, processing_timestamp) AS slot FROM cleaned) AS s
      GROUP BY device_id) AS c
LEFT JOIN (SELECT device_id, time_bucket(INTERVAL 15 minutes, processing_timestamp) AS slot, count(*) AS n
           FROM cleaned GROUP BY ALL) AS n
ON c.device_id IS NOT DISTINCT FROM n.device_id AND c.slot_start = n.slot""")


@register("slot_calendar", SLOT_CALENDAR_SQL)
def q_slot_calendar(spark, sf_dir):
    """Every slot between a device's first and last reading, empty ones too."""
    return aggregate.fill_slots(aggregate.slot_availability(_cleaned(spark, sf_dir)))


@register("latest_daily_topk", O.sql(["daily"], """
SELECT device_id, date, (CASE WHEN isnan(CAST(maxtemp_c AS DOUBLE)) THEN CAST(maxtemp_c AS DOUBLE) ELSE CAST(round(CAST(CAST(maxtemp_c AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS maxtemp_c, (CASE WHEN isnan(CAST(mintemp_c AS DOUBLE)) THEN CAST(mintemp_c AS DOUBLE) ELSE CAST(round(CAST(CAST(mintemp_c AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS mintemp_c, is_anomaly
FROM daily ORDER BY date DESC, device_id ASC LIMIT 10"""))
def q_latest_daily_topk(spark, sf_dir):
    d = _daily(spark, sf_dir).select("device_id", "date", "maxtemp_c", "mintemp_c", "is_anomaly")
    top = d.orderBy(F.col("date").desc(), F.col("device_id").asc()).limit(10)
    return r6(top, "maxtemp_c", "mintemp_c")


_RUNNING_SQL = O.sql(["cleaned"], "SELECT reading_id, " + O.r6("coalesce(score, 0.0)", "anomaly_score") + """,
 coalesce(score, 0.0) > 2.0 AS is_anomaly
FROM (SELECT reading_id, """ + " + ".join(O._z(f) for f in O.FEATURES) + """ AS score
      FROM cleaned c LEFT JOIN (
        SELECT d.device_id AS of_device, d.date AS of_date, """ + ", ".join(
    f"avg(p.{f}) AS mean_{f}, stddev_samp(p.{f}) AS stddev_{f}" for f in O.FEATURES) + """
        FROM (SELECT DISTINCT device_id, date FROM cleaned) d JOIN cleaned p ON p.device_id = d.device_id
          AND CAST(p.date AS DATE) BETWEEN CAST(d.date AS DATE) - 7 AND CAST(d.date AS DATE) - 1
        GROUP BY d.device_id, d.date) r ON c.device_id = r.of_device AND c.date = r.of_date) s""")


@register("zscore_running", _RUNNING_SQL)
def q_zscore_running(spark, sf_dir):
    """Scores against each device's seven days before, from moments of eight
    micro-batches; a null value scores 0 here."""
    rows = _cleaned(spark, sf_dir)
    batch = F.pmod(F.xxhash64("reading_id"), F.lit(8)).alias("batch")
    parts = running.day_moments(rows.select("*", batch), keys=("device_id", "date", "batch"))
    scored = running.score_running(rows, running.merge_moments(parts))
    score = F.coalesce("anomaly_score", F.lit(0.0))
    return r6(scored.select("reading_id", score.alias("anomaly_score"), (score > 2.0).alias("is_anomaly")),
              "anomaly_score")


# ------------------------------------------------------------------- series


def _one_each(spark, sf_dir, *columns) -> DataFrame:
    """Readings de-duplicated on device and time, with what is asked for alone:
    the survivor is the lowest reading id, so no other column is shuffled."""
    rows = _cleaned(spark, sf_dir).select("reading_id", "device_id", "processing_timestamp", *columns)
    return series.parse_and_dedup(rows)


@register("dedup_device_ts", O.sql(["dedup_clean"],
                                   "SELECT reading_id, device_id, processing_timestamp FROM dedup_clean"))
def q_dedup_device_ts(spark, sf_dir):
    d = _one_each(spark, sf_dir)
    return d.select("reading_id", "device_id", "processing_timestamp")


@register("time_diff", O.sql(["lag_clean"], "SELECT reading_id, device_id, time_diff FROM lag_clean"))
def q_time_diff(spark, sf_dir):
    d = series.time_diff(_one_each(spark, sf_dir))
    return d.select("reading_id", "device_id", "time_diff")


@register("tair_step", O.sql(["lag_clean"], "SELECT reading_id, device_id, tair_step FROM lag_clean"))
def q_tair_step(spark, sf_dir):
    d = series.step(_one_each(spark, sf_dir, "air_temperature"))
    return d.select("reading_id", "device_id", "tair_step")


# ----------------------------------------------------------------------- QC

def _raw_code(name: str, col: str, mode=P.AS_WRITTEN):
    sql_expr = O.qc_exprs(mode)[name]
    sql_text = O.sql(["readings"], f"SELECT reading_id, {col}, {sql_expr} AS {name} FROM readings")

    def fn(spark, sf_dir):
        return _readings(spark, sf_dir).select("reading_id", col, qc.check_code(name, mode=mode).alias(name))
    return fn, sql_text


for _name, _col, _modes in [
    ("QC_Tair_range", "air_temperature", P.MODES),
    ("QC_RH_range", "air_humidity", P.MODES),
    ("QC_WindSpeed_range", "wind_speed", P.MODES),
    ("QC_WindDir_range", "wind_direction_sensor", (P.AS_WRITTEN,)),
    ("QC_WindDir_requires_wind", "wind_speed", (P.AS_WRITTEN,)),
    ("QC_Rain_15min", "rain_gauge", P.MODES),
]:
    for _mode in _modes:
        _q, _s = _raw_code(_name, _col, _mode)
        register(_name.lower() + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


@register("qc_time_gap", O.sql(["lag_clean"], f"""
SELECT reading_id, time_diff, {O.qc_exprs('as_written')['QC_time_gap']} AS QC_time_gap FROM lag_clean"""))
def q_qc_time_gap(spark, sf_dir):
    d = series.time_diff(_one_each(spark, sf_dir))
    return qc.add_checks(d, "QC_time_gap").select("reading_id", "time_diff", "QC_time_gap")


def _step_query(mode):
    def fn(spark, sf_dir):
        d = series.step(_one_each(spark, sf_dir, "air_temperature"))
        return qc.add_checks(d, "QC_Tair_step", mode=mode).select("reading_id", "tair_step", "QC_Tair_step")
    sql_text = O.sql(["lag_clean"], f"SELECT reading_id, tair_step, "
                                    f"{O.qc_exprs(mode)['QC_Tair_step']} AS QC_Tair_step FROM lag_clean")
    return fn, sql_text


for _mode in (P.AS_WRITTEN, P.CORRECTED):
    _q, _s = _step_query(_mode)
    register("qc_tair_step" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


def _daily_check_query(mode):
    codes = O.qc_exprs(mode)

    def fn(spark, sf_dir):
        d = series.daily_metrics_join(_cleaned(spark, sf_dir))
        d = qc.add_checks(d, "QC_Daily_Availability", "QC_Rain_Daily", mode=mode)
        return d.select("reading_id", "daily_valid_frac", "daily_rain_mm",
                        "QC_Daily_Availability", "QC_Rain_Daily")
    sql_text = O.sql(["cleaned", "daily_metrics_clean"], f"""
SELECT reading_id, daily_valid_frac, daily_rain_mm,
 {codes['QC_Daily_Availability']} AS QC_Daily_Availability, {codes['QC_Rain_Daily']} AS QC_Rain_Daily
FROM (SELECT c.reading_id, m.daily_valid_frac, m.daily_rain_mm FROM cleaned c
      LEFT JOIN daily_metrics_clean m ON c.device_id = m.device_id AND c.date = m.date)""")
    return fn, sql_text


for _mode in (P.AS_WRITTEN, P.CORRECTED):
    _q, _s = _daily_check_query(_mode)
    register("qc_daily_checks" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


def _daily_single(name, cols, mode):
    codes = O.qc_exprs(mode)

    def fn(spark, sf_dir):
        d = series.daily_metrics_join(_cleaned(spark, sf_dir))
        d = qc.add_checks(d, name, mode=mode)
        return d.select("reading_id", *cols, name)
    sql_text = O.sql(["cleaned", "daily_metrics_clean"], f"""
SELECT reading_id, {', '.join(cols)}, {codes[name]} AS {name}
FROM (SELECT c.reading_id, m.daily_valid_frac, m.daily_rain_mm FROM cleaned c
      LEFT JOIN daily_metrics_clean m ON c.device_id = m.device_id AND c.date = m.date)""")
    return fn, sql_text


_q, _s = _daily_single("QC_Daily_Availability", ["daily_valid_frac"], P.AS_WRITTEN)
register("qc_daily_availability", _s)(_q)
for _mode in (P.AS_WRITTEN, P.CORRECTED):
    _q, _s = _daily_single("QC_Rain_Daily", ["daily_rain_mm"], _mode)
    register("qc_rain_daily" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


_PRESSURE_SQL = """
SELECT reading_id, CASE WHEN (SELECT median(barometric_pressure) FROM readings) > 2000
 THEN CAST(barometric_pressure AS DOUBLE) / 100.0 ELSE CAST(barometric_pressure AS DOUBLE) END AS pressure_hpa
FROM readings"""


@register("pressure_hpa", O.sql(["readings"], _PRESSURE_SQL))
def q_pressure_hpa(spark, sf_dir):
    d = qc.convert_pressure_hpa(_readings(spark, sf_dir).select("reading_id", "barometric_pressure"))
    return d.select("reading_id", "pressure_hpa")


def _pressure_range_query(mode):
    def fn(spark, sf_dir):
        d = qc.convert_pressure_hpa(_readings(spark, sf_dir).select("reading_id", "barometric_pressure"))
        d = qc.add_checks(qc.expected_pressure(d), "QC_Pressure_range", mode=mode)
        return r6(d.select("reading_id", "pressure_hpa", "pressure_abs_dev_hpa", "QC_Pressure_range"),
                  "pressure_abs_dev_hpa")
    code = O.code3("(pressure_hpa < 750.0 OR pressure_hpa > 1010.0 OR pressure_abs_dev_hpa > 40.0)",
                   "(pressure_abs_dev_hpa < 40.0)", "(pressure_abs_dev_hpa < 25.0)", mode)
    sql_text = O.sql(["readings"], f"""
SELECT reading_id, pressure_hpa, (CASE WHEN isnan(CAST(pressure_abs_dev_hpa AS DOUBLE)) THEN CAST(pressure_abs_dev_hpa AS DOUBLE) ELSE CAST(round(CAST(CAST(pressure_abs_dev_hpa AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) END) AS pressure_abs_dev_hpa, {code} AS QC_Pressure_range
FROM (SELECT *, abs(pressure_hpa - 1013.25 * exp(-0.0 / 8434.0)) AS pressure_abs_dev_hpa
      FROM ({_PRESSURE_SQL}))""")
    return fn, sql_text


for _mode in (P.AS_WRITTEN, P.CORRECTED):
    _q, _s = _pressure_range_query(_mode)
    register("qc_pressure_range" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


_STATIONS_SQL = """
SELECT concat('dev', CAST(s_suppkey % 5 AS VARCHAR(20))) AS device_id,
 CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey * 37 % 1500 AS DOUBLE) END AS altitude,
 CAST(concat('2024-01-', lpad(CAST(2 + s_suppkey % 27 AS VARCHAR(20)), 2, '0'), ' 06:00:00') AS TIMESTAMP) AS valid_from
FROM supplier"""


def stations(spark, sf_dir) -> DataFrame:
    """A station dimension derived from ``supplier``: devices that move, some
    at an unknown altitude, none before the first of its rows."""
    load_table(spark, sf_dir, "supplier").createOrReplaceTempView("meteoframe_supplier")
    return spark.sql(_STATIONS_SQL.replace("FROM supplier", "FROM meteoframe_supplier"))


def _pressure_altitude_query(mode):
    def fn(spark, sf_dir):
        rows = _readings(spark, sf_dir).select("reading_id", "device_id", "processing_timestamp", "barometric_pressure")
        d = qc.convert_pressure_hpa(qc.with_station(rows, stations(spark, sf_dir)))
        d = qc.add_checks(qc.expected_pressure(d), "QC_Pressure_range", mode=mode)
        return r6(d.select("reading_id", "altitude", "pressure_abs_dev_hpa", "QC_Pressure_range"),
                  "pressure_abs_dev_hpa")
    code = O.code3("(pressure_hpa < 750.0 OR pressure_hpa > 1010.0 OR pressure_abs_dev_hpa > 40.0)",
                   "(pressure_abs_dev_hpa < 40.0)", "(pressure_abs_dev_hpa < 25.0)", mode)
    sql_text = O.sql(["readings"], f"""
SELECT reading_id, altitude, {O.r6("pressure_abs_dev_hpa", "pressure_abs_dev_hpa")}, {code} AS QC_Pressure_range
FROM (SELECT *, abs(pressure_hpa - 1013.25 * exp(-coalesce(altitude, 0.0) / 8434.0)) AS pressure_abs_dev_hpa
      FROM ({_PRESSURE_SQL}) AS p JOIN (
        SELECT r.reading_id AS of_reading, s.altitude FROM readings r ASOF LEFT JOIN (
          SELECT device_id, valid_from, max(altitude) AS altitude FROM ({_STATIONS_SQL}) AS t
          GROUP BY device_id, valid_from) AS s
        ON r.device_id = s.device_id AND r.processing_timestamp >= s.valid_from) AS a ON p.reading_id = a.of_reading)""")
    return fn, sql_text


for _mode in (P.AS_WRITTEN, P.CORRECTED):
    _q, _s = _pressure_altitude_query(_mode)
    register("qc_pressure_altitude" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


_QC_OUT = ["reading_id", "device_id", "uv_index", "rain_gauge", "wind_speed", "air_humidity",
           "peak_wind_gust", "air_temperature", "light_intensity", "rain_accumulation",
           "barometric_pressure", "wind_direction_sensor", "processing_timestamp", "date",
           "time_diff", "pressure_hpa", "tair_step", "daily_valid_frac", "daily_rain_mm",
           *P.QC_COLUMNS, "qc_failed_checks", "qc_warning_checks"]
_QC_ROUND = ["uv_index", "wind_speed", "peak_wind_gust", "air_temperature",
             "rain_accumulation", "tair_step"]


def _qc_full_sql(final_cte: str, mode: str) -> str:
    cols = [O.r6(c, c) if c in _QC_ROUND else c for c in _QC_OUT[:-2]]
    return O.sql([final_cte], f"SELECT {', '.join(cols)}, {O.name_lists(mode)} FROM {final_cte}")


QC_CORRECTED_SQL = _qc_full_sql(O.QC_CLEAN_CORR, "corrected")


def qc_result(audit: DataFrame) -> DataFrame:
    """The audit's columns as the registered queries return them."""
    return r6(audit.select(*_QC_OUT), *_QC_ROUND)


@register("qc_level1", _qc_full_sql(O.QC_IMPUTED, "as_written"))
def q_qc_level1(spark, sf_dir):
    return qc_result(pipeline.qc_audit(_readings(spark, sf_dir), P.AS_WRITTEN))


@register("qc_level1_corrected", QC_CORRECTED_SQL)
def q_qc_level1_corrected(spark, sf_dir):
    return qc_result(pipeline.qc_audit(_readings(spark, sf_dir), P.CORRECTED))


def _collect_query(mode, final_cte):
    def fn(spark, sf_dir):
        raw = clean.derive_date(_readings(spark, sf_dir))
        d = qc.qc_level1(raw, mode=mode)
        return d.select("reading_id", *P.QC_COLUMNS, "qc_failed_checks", "qc_warning_checks")
    sql_text = O.sql([final_cte], f"SELECT reading_id, {', '.join(P.QC_COLUMNS)}, "
                                  f"{O.name_lists(mode)} FROM {final_cte}")
    return fn, sql_text


for _mode, _cte_name in ((P.AS_WRITTEN, O.QC_RAW), (P.CORRECTED, O.QC_RAW_CORR)):
    _q, _s = _collect_query(_mode, _cte_name)
    register("qc_collect" + ("_corrected" if _mode == P.CORRECTED else ""), _s)(_q)


@register("batch_tables_daily", O.sql(["daily"], f"SELECT {O.DAILY_COLS} FROM daily"))
def q_batch_tables_daily(spark, sf_dir):
    """The batch job: clean table written once, daily summary derived from
    it and written; returns the daily table as stored."""
    from ..session import scratch_path
    paths = pipeline.write_tables(_readings(spark, sf_dir), scratch_path(spark, "tables"))
    d = spark.read.parquet(paths["daily"]).withColumn("date", F.date_format("date", P.DATE_FORMAT))
    return r6(d, "maxtemp_c", "mintemp_c", "avgtemp_c", "anomaly_score")


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: per device-day summary of the whole cleaned, imputed,
    scored readings table."""
    return q_daily_summary(spark, sf_dir)


__all__ = ["QUERIES", "ORACLE", "entry_query"]
