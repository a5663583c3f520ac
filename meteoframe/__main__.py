"""Command line: run the batch table job or the streaming pipeline.

    spark-submit --py-files meteoframe.zip submit.py stream \
        --kafka-bootstrap HOST:PORT --topic T --out ROOT --checkpoint SHARED_DIR
    python -m meteoframe stream --files DIR --out ROOT --available-now
    python -m meteoframe batch --readings PATH --out ROOT
    python -m meteoframe stats --readings PATH --out STATS      # then --stats STATS
    python -m meteoframe publish --readings PATH --files DIR

Settings not given as options are read from the environment
(``KAFKA_BOOTSTRAP_SERVERS``, ``KAFKA_TOPIC_RAW``, ``MAX_OFFSETS_PER_TRIGGER``,
``CHECKPOINT_LOCATION``); nothing has a credential default.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from . import params as P


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="meteoframe")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="decode -> de-dup -> per-batch fan-out to tables")
    src = s.add_mutually_exclusive_group()
    src.add_argument("--files", help="directory of JSON-lines envelope files (file source)")
    src.add_argument("--kafka-bootstrap", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS"))
    s.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC_RAW"))
    s.add_argument("--max-offsets", type=int,
                   default=int(os.environ.get("MAX_OFFSETS_PER_TRIGGER", "1000")))
    s.add_argument("--max-files", type=int, default=1)
    s.add_argument("--out", required=True,
                   help="root folder of the output tables (of the pipeline state with --jdbc-url)")
    s.add_argument("--jdbc-url", default=os.environ.get("JDBC_URL"),
                   help="write tables through JDBC (append); credentials from JDBC_USER, "
                        "JDBC_PASSWORD in the environment")
    s.add_argument("--jdbc-driver", default=os.environ.get("JDBC_DRIVER"))
    s.add_argument("--checkpoint", default=os.environ.get("CHECKPOINT_LOCATION"))
    s.add_argument("--mode", choices=P.MODES, default=P.AS_WRITTEN)
    s.add_argument("--keep-resent", action="store_true", help="write re-sent readings again")
    s.add_argument("--unique-ids", action="store_true",
                   help="drop a reading id sent again with another event time too")
    s.add_argument("--stats", help="table of reference statistics (see the stats command)")
    s.add_argument("--slots", action="store_true", help="keep 15-minute slot counts")
    s.add_argument("--stats-by", nargs="*", default=[])
    s.add_argument("--available-now", action="store_true",
                   help="process what is there and stop (default: run until stopped)")

    pub = sub.add_parser("publish", help="readings table -> one JSON envelope per reading")
    pub.add_argument("--readings", required=True, help="parquet table of flat readings")
    dst = pub.add_mutually_exclusive_group(required=True)
    dst.add_argument("--files", help="write JSON-lines envelope files here")
    dst.add_argument("--kafka-bootstrap")
    pub.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC_RAW"))
    pub.add_argument("--n-files", type=int, default=8, help="time-ordered files (file target)")

    b = sub.add_parser("batch", help="clean, daily and QC tables from a readings table")
    b.add_argument("--readings", required=True, help="parquet table of flat readings")
    b.add_argument("--out", required=True)
    b.add_argument("--mode", choices=P.MODES, default=P.AS_WRITTEN)
    b.add_argument("--stats-by", nargs="*", default=[])
    b.add_argument("--stats", help="table of reference statistics (see the stats command)")

    r = sub.add_parser("stats", help="reference statistics for imputation and scores")
    r.add_argument("--readings", required=True, help="parquet table of the reference period")
    r.add_argument("--out", required=True)
    r.add_argument("--stats-by", nargs="*", default=[])
    return ap


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    from .session import build_session
    spark = build_session(app=f"meteoframe-{args.cmd}")

    if args.cmd == "batch":
        from .plans import pipeline
        from .session import input_bytes, sizing
        for key, value in sizing(input_bytes(spark, args.readings)).items():
            spark.conf.set(key, value)
        paths = pipeline.write_tables(spark.read.parquet(args.readings), args.out, mode=args.mode,
                                      stats_by=tuple(args.stats_by),
                                      stats=spark.read.parquet(args.stats) if args.stats else None)
        logging.getLogger("meteoframe").info("wrote %s", paths)
        return 0

    if args.cmd == "stats":
        from .operators import anomaly
        from .plans import pipeline
        cleaned = pipeline.cleaned(spark.read.parquet(args.readings))
        anomaly.reference_stats(cleaned, by=tuple(args.stats_by)).write.mode("overwrite").parquet(args.out)
        return 0

    from .streaming import fanout, sources
    if args.cmd == "publish":
        readings = spark.read.parquet(args.readings)
        if args.files:
            sources.write_envelope_files(readings, args.files, args.n_files)
        else:
            if not args.topic:
                print("publish: --topic is required with --kafka-bootstrap", file=sys.stderr)
                return 2
            from .sources import envelope
            sources.write_kafka(envelope.encode_envelope(readings), args.kafka_bootstrap, args.topic)
        return 0

    if args.files:
        raw = sources.read_envelope_files(spark, args.files, args.max_files)
    else:
        if not (args.kafka_bootstrap and args.topic):
            print("stream: give --files, or --kafka-bootstrap and --topic", file=sys.stderr)
            return 2
        raw = sources.read_kafka_stream(spark, sources.kafka_options(
            args.kafka_bootstrap, args.topic, max_offsets_per_trigger=args.max_offsets))
    common = dict(root=args.out, mode=args.mode, stats_by=tuple(args.stats_by), stats=args.stats,
                  slots=args.slots, unique_ids=args.unique_ids)
    if args.jdbc_url:
        targets = fanout.JdbcTargets(**common, url=args.jdbc_url, user=os.environ.get("JDBC_USER"),
                                     password=os.environ.get("JDBC_PASSWORD"),
                                     driver=args.jdbc_driver)
    else:
        targets = fanout.Targets(**common)
    q = fanout.start_pipeline(spark, raw, targets, checkpoint=args.checkpoint,
                              dedup=not args.keep_resent, available_now=args.available_now)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
