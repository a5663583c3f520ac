"""Every registered query equals its DuckDB oracle on the small tables."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

# the removable training-data queries are tested in their own folder
QUERIES = {n: q for n, q in E.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLE = E.oracle_sql()
# the other streaming queries run in the driver's check and in test_streaming
SLOW = {"stream_fanout", "stream_newest_first", "stream_daily_corrected", "stream_slot_availability"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLE and n not in SLOW))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "maxtemp_c" in df.columns and "is_anomaly" in df.columns


def test_rows_only_queries_run(spark):
    for name in QUERIES:
        if name not in ORACLE:
            assert QUERIES[name](spark, SF_SMALL).count() >= 0
