"""Data-quality gate as a report: every rule evaluated in one aggregate.

Instead of one eager job per rule and a bare boolean, the gate is a lazy
DataFrame ``(rule, passed, observed)`` with a final ``all`` row; a sink
writes only when ``all`` passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rule(name: str, passed: Column, observed: Column) -> Column:
    return F.struct(F.lit(name).alias("rule"),
                    F.coalesce(passed, F.lit(False)).alias("passed"),
                    observed.cast("double").alias("observed"))


def quality_report(df: DataFrame, daily: bool = True) -> DataFrame:
    """Rules: the table is non-empty; for a daily summary also no null
    device or date, minimum and maximum temperature present, min <= max and
    mean humidity within [0, 100]. The ``all`` row is their conjunction."""
    n = F.count(F.lit(1))
    rules = [("non_empty", n > 0, n)]
    if daily:
        null_dev = F.count_if(F.col("device_id").isNull())
        null_date = F.count_if(F.col("date").isNull())
        lo, hi = F.min("mintemp_c"), F.max("maxtemp_c")
        hum = F.avg("avghumidity")
        rules += [
            ("device_id_not_null", null_dev == 0, null_dev),
            ("date_not_null", null_date == 0, null_date),
            ("min_temp_present", lo.isNotNull(), lo),
            ("max_temp_present", hi.isNotNull(), hi),
            ("min_le_max", lo <= hi, hi - lo),
            ("avg_humidity_in_range", hum.between(0, 100), hum),
        ]
    cols = [_rule(name, p, o).alias(f"r{i}") for i, (name, p, o) in enumerate(rules)]
    one = df.agg(*cols)
    passed_all = F.lit(True)
    for i in range(len(rules)):
        passed_all = passed_all & F.col(f"r{i}.passed")
    allrow = F.struct(F.lit("all").alias("rule"), passed_all.alias("passed"),
                      F.lit(None).cast("double").alias("observed"))
    return one.select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(rules))], allrow)))


def gate_passed(report: DataFrame) -> bool:
    """Driver-side decision from a (tiny) report: one row is fetched."""
    row = report.filter(F.col("rule") == "all").select("passed").first()
    return bool(row and row["passed"])
