"""Plan regression: the physical properties the scale design relies on."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream", "src_stream", "batch_tables")))


def final_plan(df) -> str:
    """The executed (final adaptive) physical plan, via the public explain()."""
    import contextlib
    import io
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


@pytest.fixture(scope="module")
def plans(spark):
    return {n: final_plan(QUERIES[n](spark, SF_SMALL)) for n in BATCH}


def test_no_python_udf_and_no_cartesian_product(plans):
    for name, plan in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                     "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def test_nested_loop_joins_attach_one_row_aggregates(plans):
    """Every nested-loop join broadcasts a global aggregate (no grouping
    keys: exactly one row), so no join pairs rows."""
    seen = 0
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "BroadcastNestedLoopJoin" not in line:
                continue
            seen += 1
            d = _indent(line)
            j = next(k for k in range(i + 1, len(lines))
                     if _indent(lines[k]) > d and ("BroadcastExchange" in lines[k]
                                                    or "BroadcastQueryStage" in lines[k]))
            agg = next(lines[k] for k in range(j, len(lines)) if "Aggregate(keys=" in lines[k]
                       or "ReusedExchange" in lines[k])
            assert "keys=[]" in agg or "ReusedExchange" in agg, (name, agg)
    assert seen > 0


def test_events_scan_is_column_pruned(plans):
    for name, plan in plans.items():
        for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
            if "event_id" in schema:
                assert "props" not in schema or name == "json_decode_props", (name, schema)
                assert "event_type" not in schema, (name, schema)


def test_flagship_reads_input_twice_and_shuffles_once(plans):
    plan = plans["daily_summary"]
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortMergeJoin" not in plan


def test_qc_chain_reuses_the_dedup_exchange(plans):
    plan = plans["qc_level1"]
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet", plan)) <= 2
    assert "SortMergeJoin" not in plan


def test_lags_shuffle_only_what_they_need(plans):
    for name in ("dedup_device_ts", "time_diff", "qc_time_gap", "tair_step", "qc_tair_step"):
        for line in re.findall(r"Exchange hashpartitioning.*|Exchange.*\n.*SortAggregate.*", plans[name]):
            assert "wind_speed" not in line
        for schema in re.findall(r"min\(struct\(([^)]*)\)\)", plans[name]):
            assert "wind_speed" not in schema and "barometric_pressure" not in schema, name


def test_slot_calendar_adds_up_without_a_join(plans):
    assert "Join" not in plans["slot_calendar"]


def test_slot_stream_is_a_watermarked_stateful_aggregation(spark, capsys):
    from meteoframe.session import scratch_path
    from meteoframe.streaming import fanout, sources
    src = scratch_path(spark, "t-plan-src")
    flat = sources.decode_stream(sources.read_envelope_files(spark, src), keep_raw=False)
    slots = fanout.slot_counts_stream(flat)
    slots.explain(True)
    logical = capsys.readouterr().out
    assert "EventTimeWatermark" in logical
    assert "StateStoreSave" in logical and "HashAggregate" in logical
