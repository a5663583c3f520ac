"""The command line runs the batch job and the file-source stream."""

from meteoframe.__main__ import main
from meteoframe.session import scratch_path
from meteoframe.sources.tables import load_readings
from meteoframe.streaming import sources
from tests.conftest import SF_SMALL


def test_cli_batch_and_stream(spark):
    readings = load_readings(spark, SF_SMALL)
    table = scratch_path(spark, "cli-readings")
    readings.write.mode("overwrite").parquet(table)
    out = scratch_path(spark, "cli-out")
    assert main(["batch", "--readings", table, "--out", out]) == 0
    assert spark.read.parquet(out + "/daily").count() == 120

    src = scratch_path(spark, "cli-src")
    assert main(["publish", "--readings", table, "--files", src, "--n-files", "2"]) == 0
    sources.order_files_by_name(src)
    out2 = scratch_path(spark, "cli-stream")
    assert main(["stream", "--files", src, "--out", out2, "--checkpoint",
                 scratch_path(spark, "cli-ckpt"), "--available-now"]) == 0
    assert spark.read.parquet(out2 + "/raw").count() == readings.count()


def test_cli_reference_statistics(spark):
    table, stats, out = (scratch_path(spark, f"cli-{n}") for n in ("readings", "stats", "out"))
    load_readings(spark, SF_SMALL).write.mode("overwrite").parquet(table)
    assert main(["stats", "--readings", table, "--out", stats]) == 0
    assert main(["batch", "--readings", table, "--out", out, "--stats", stats]) == 0
    assert spark.read.parquet(out + "/daily").count() == 120


def test_cli_stream_needs_a_source(spark):
    assert main(["stream", "--out", scratch_path(spark, "cli-none")]) == 2
