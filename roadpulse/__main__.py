"""Command line: ``spark-submit --py-files roadpulse.zip -m roadpulse <job> ...``
or ``python -m roadpulse <job> ...`` (the session comes from the
environment; ``--local`` starts a local one for trials).

Jobs:
  ingest           raw readings CSV -> split, partitioned Parquet (+ counters);
                   --checkpoint: only the files that arrived since
  compact-raw      partitioned readings -> time-sorted files, separate root
  historical       five historical results for a year (or all data)
  compact-results  one file per result and year, separate root
  live             the four streaming queries (Kafka or a folder of JSON lines);
                   --shared: two queries, one window state for the three results
  replay           readings -> per-slice JSON-line folders, or a Kafka topic
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .session import REQUIRED_CONF, local_session, scratch_path


def _session(args) -> SparkSession:
    if args.local:
        return local_session()
    spark = SparkSession.builder.appName(f"roadpulse-{args.job}").getOrCreate()
    for k, v in REQUIRED_CONF.items():  # runtime SQL settings
        spark.conf.set(k, v)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="roadpulse")
    p.add_argument("--local", action="store_true", help="start a local[*] session")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("ingest")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--historical", nargs=2, required=True, metavar=("FROM", "TO"))
    s.add_argument("--replay", nargs=2, required=True, metavar=("FROM", "TO"))
    s.add_argument("--checkpoint", help="take only files that this ledger doesn't know; what earlier ones gave stays")

    s = sub.add_parser("compact-raw")
    s.add_argument("--src", required=True)
    s.add_argument("--dst", required=True)

    s = sub.add_parser("historical")
    s.add_argument("--raw", required=True)
    s.add_argument("--segments", required=True, help="segment lookup CSV")
    s.add_argument("--out", required=True)
    s.add_argument("--year", type=int)
    s.add_argument("--months", type=int, nargs="*")
    s.add_argument("--yearly", action="store_true", help="per year instead of per month")
    s.add_argument("--sums", help="table of partial sums: brought up to date for the year and months, results merged from it")

    s = sub.add_parser("compact-results")
    s.add_argument("--src", required=True)
    s.add_argument("--dst", required=True)
    s.add_argument("--year", type=int, required=True)

    s = sub.add_parser("live")
    s.add_argument("--segments", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--kafka", help="bootstrap servers (else --files)")
    s.add_argument("--topic", default="road-segments")
    s.add_argument("--files", help="folder of JSON-line files")
    s.add_argument("--result-trigger", default="2 minutes")
    s.add_argument("--snapshot-trigger", default="20 seconds")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--carry-forward", action="store_true")
    s.add_argument("--late", help="folder of a side table of late readings")
    s.add_argument("--malformed", help="folder of the messages that can't be read")
    s.add_argument("--latest", help="folder of the keyed latest state (changed segments only)")
    s.add_argument("--expire-minutes", type=int, help="drop a silent segment from the keyed latest state")
    s.add_argument("--shared", action="store_true",
                   help="the three windowed results from one query (one state, exact network KPI)")

    s = sub.add_parser("replay")
    s.add_argument("--raw", required=True)
    s.add_argument("--start", required=True)
    s.add_argument("--end")
    s.add_argument("--minutes", type=int, default=10)
    s.add_argument("--out", help="folder for per-slice JSON lines")
    s.add_argument("--checkpoint", help="where a replay to a topic that was stopped goes on")
    s.add_argument("--slices-per-batch", type=int, default=1)
    s.add_argument("--interval", default="0 seconds", help="pace of a replay to a topic: time between its batches")
    s.add_argument("--kafka", help="bootstrap servers")
    s.add_argument("--topic", default="road-segments")

    args = p.parse_args(argv)
    spark = _session(args)

    if args.job == "ingest":
        ranges = tuple(args.historical), tuple(args.replay)
        if args.checkpoint:
            from .plans.incremental import ingest_new
            print(json.dumps(ingest_new(spark, args.csv, args.out, args.checkpoint, *ranges)))
        else:
            from .plans.prepare import ingest
            print(json.dumps(ingest(spark, args.csv, args.out, *ranges)))
    elif args.job == "compact-raw":
        from .plans.prepare import compact_raw
        compact_raw(spark, args.src, args.dst)
    elif args.job == "historical":
        from .operators.historical import MONTHLY, YEARLY
        from .plans.batch import run_historical
        from .plans.rollup import run_from_sums, update_sums
        from .sources.readers import read_segments_csv
        segments = read_segments_csv(spark, args.segments)
        if args.sums:
            update_sums(spark, args.raw, args.sums, args.year, args.months)
            paths = run_from_sums(spark, args.sums, segments, args.out, args.year, args.months)
        else:
            paths = run_historical(spark, args.raw, segments, args.out, args.year, args.months,
                                   YEARLY if args.yearly else MONTHLY)
        print(json.dumps(paths))
    elif args.job == "compact-results":
        from .plans.batch import compact_results
        compact_results(spark, args.src, args.dst, args.year)
    elif args.job == "live":
        from .sources.kafka import kafka_stream
        from .sources.readers import read_segments_csv
        from .streaming.live import LateRows, cleaned_stream, file_stream, start_all
        if args.kafka:
            raw = kafka_stream(spark, args.kafka, args.topic)
        elif args.files:
            raw = file_stream(spark, args.files)
        else:
            p.error("live needs --kafka or --files")
        start = start_all
        if args.shared:
            from .streaming.shared import start_shared as start
        late = LateRows()
        spark.streams.addListener(late)
        queries = start(spark, raw, read_segments_csv(spark, args.segments), args.out, args.checkpoints,
                        args.result_trigger, args.snapshot_trigger, args.available_now,
                        args.carry_forward)
        more = dict(interval=args.result_trigger, available_now=args.available_now)
        if args.late:
            from .streaming.late import start_late
            queries.append(start_late(cleaned_stream(raw), args.late, f"{args.checkpoints}/late", **more))
        if args.malformed:
            from .streaming.messages import start_malformed
            queries.append(start_malformed(raw, args.malformed, f"{args.checkpoints}/malformed", **more))
        if args.latest:
            from .streaming.latest import start_latest
            queries.append(start_latest(cleaned_stream(raw), args.latest, f"{args.checkpoints}/latest", args.snapshot_trigger,
                                        args.available_now, args.expire_minutes))
        if args.available_now:  # each query stops when its input is done
            for q in queries:
                q.awaitTermination()
            spark.streams.removeListener(late)
            print(json.dumps({"late_rows": {q.name or str(q.id): late.counted(q) for q in queries}}))
        else:  # if one query fails, stop the job (its checkpoint resumes it)
            spark.streams.awaitAnyTermination()
    elif args.job == "replay":
        from .operators.replay import write_message_slices
        from .sources import kafka
        from .sources.readers import read_readings
        readings = read_readings(spark, args.raw, start=args.start, end=args.end)
        if args.out:
            write_message_slices(readings, args.out, args.start, args.end, args.minutes)
        elif args.kafka:
            checkpoint = args.checkpoint or scratch_path(spark, "replay-checkpoint")
            slices = kafka.replay_kafka(readings, args.kafka, args.topic, checkpoint, args.start, args.end, args.minutes,
                                        args.slices_per_batch, args.interval)
            print(json.dumps({"slices": slices}))
        else:
            p.error("replay needs --out or --kafka")
    return 0


if __name__ == "__main__":
    sys.exit(main())
