"""Job entry points, for spark-submit or `python -m riskstream`."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskstream.plans.compaction import compact, compact_in_place
from riskstream.plans.hourly import run_hour
from riskstream.plans.repair import repair_alerts
from riskstream.plans.serving import load_serving
from riskstream.plans.tables import create_tables, sync_day, sync_partitions
from riskstream.settings import Settings
from riskstream.streaming.jobs import run_dual_write_stream, run_stream


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskstream")
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--database", default="default")
    parser.add_argument("--hive", action="store_true", help="keep tables in the cluster's metastore")
    parser.add_argument("--set", action="append", default=[], type=Settings.parsed, metavar="NAME=VALUE", dest="changes",
                        help="any field of Settings, for example watermark_delay='5 minutes'; stands before the job, may be repeated, wins over the job's own options")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("stream", "dual-write"):
        job = jobs.add_parser(name)
        job.add_argument("--bootstrap", required=True)
        job.add_argument("--body", choices=["avro", "json"], default="avro")
        job.add_argument("--trigger", default="5 seconds" if name == "stream" else "10 seconds")
        job.add_argument("--max-offsets", type=int, default=0)
        job.add_argument("--store", metavar="MODULE:FUNCTION", help="opens a keyed store on the executors")
    jobs.choices["stream"].add_argument("--starting-offsets", default="latest")
    jobs.choices["stream"].add_argument("--fail-on-data-loss", action="store_true")
    jobs.choices["stream"].add_argument("--split", action="store_true", help="layers and alerts as two queries")
    for name in ("hour", "compact"):
        job = jobs.add_parser(name)
        job.add_argument("dt")
        job.add_argument("hr", type=int, nargs="?" if name == "compact" else None, help="left out: the whole day")
    jobs.add_parser("serving").add_argument("dt")
    jobs.add_parser("repair", help="append alerts that the watermark refused").add_argument("dt")
    jobs.choices["compact"].add_argument("--in-place", metavar="TAG", help="route to compact into itself")
    jobs.add_parser("tables")
    return parser.parse_args(argv)


def open_store(name: str | None) -> Callable[[], object] | None:
    """The function that `module:function` names."""
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def await_first(queries: list[StreamingQuery], poll_seconds: int = 5) -> None:
    """Until any query ends; a failed one raises, so that the job is restarted as a whole."""
    while not any(query.awaitTermination(poll_seconds) for query in queries):
        pass


def settings_of(args: argparse.Namespace) -> Settings:
    """The job's options, and over them what `--set` names."""
    settings = Settings(args.root, args.database)
    if args.job in ("stream", "dual-write"):
        settings = replace(settings, bootstrap=args.bootstrap, trigger_interval=args.trigger,
                           max_offsets_per_trigger=args.max_offsets)
    if args.job == "stream":
        settings = replace(settings, starting_offsets=args.starting_offsets, fail_on_data_loss=args.fail_on_data_loss)
    return replace(settings, **dict(args.changes))


def main(spark: SparkSession, args: argparse.Namespace) -> int:
    settings = settings_of(args)
    if args.job in ("stream", "dual-write"):
        if args.job == "stream":
            await_first(run_stream(spark, settings, args.body, open_store(args.store), args.split))
        else:
            await_first(run_dual_write_stream(spark, settings, args.body, open_store(args.store)))
    elif args.job == "serving":
        create_tables(spark, settings)
        sync_day(spark, settings, args.dt, "silver_transactions", "silver_fraud_alerts")
        load_serving(spark, settings, args.dt)
    elif args.job == "repair":
        return 0 if repair_alerts(spark, settings, args.dt) else 1
    elif args.job == "tables":
        create_tables(spark, settings)
        sync_partitions(spark, settings)
    elif args.job == "hour":
        return 0 if run_hour(spark, settings, args.dt, args.hr) else 1
    elif args.in_place:
        compact_in_place(spark, settings, args.in_place, args.dt, args.hr)
    else:
        compact(spark, settings, args.dt, args.hr)
    return 0


if __name__ == "__main__":
    arguments_given = arguments()
    builder = SparkSession.builder.appName("riskstream").config("spark.sql.session.timeZone", "UTC")
    if arguments_given.hive:
        builder = builder.enableHiveSupport()
    raise SystemExit(main(builder.getOrCreate(), arguments_given))
