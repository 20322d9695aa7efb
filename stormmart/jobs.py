"""Command-line jobs for ``spark-submit`` (one per stage of the reference's schedule).

    spark-submit --py-files stormmart.zip stormmart/jobs.py ingest \
        --landing s3://.../landing --clean s3://.../clean
    ... stormmart/jobs.py stream --landing ... --clean ... --archive ...
    ... stormmart/jobs.py clean  --clean ...
    ... stormmart/jobs.py mart   --clean ... --mart mart.yearly_damage
    ... stormmart/jobs.py models --clean ... --mart mart.yearly_damage   (clean, its tests, mart)

The session is the cluster's (``getOrCreate``); nothing here sets a master.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from stormmart.operators import quality as dq
from stormmart.plans.ingest import Layout, archive_loaded, ingest_directory, run_clean_model, run_models
from stormmart.plans.layers import yearly_damage
from stormmart.sinks.tables import materialize_table
from stormmart.sinks.upsert import read_upsert_table
from stormmart.streaming.landing_stream import FILES_PER_TRIGGER, start_ingest


def _layout(args) -> Layout:
    return Layout(raw_table=args.raw_table, log_table=args.log_table, clean_path=args.clean or "",
                  results_table=args.results_table, n_buckets=args.buckets,
                  spread_partitions=args.spread)


def _suite(args) -> dq.Suite | None:
    return dq.Suite.load(args.suite) if args.suite else None


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="stormmart.jobs")
    p.add_argument("job", choices=["ingest", "stream", "clean", "mart", "models", "archive"])
    p.add_argument("--landing")
    p.add_argument("--archive")
    p.add_argument("--clean")
    p.add_argument("--mart", default="mart.yearly_damage")
    p.add_argument("--raw-table", default="raw.storm_events")
    p.add_argument("--log-table", default="raw.storm_events_log")
    p.add_argument("--results-table", default="raw.quality_results")
    p.add_argument("--suite", help="expectation-suite JSON file")
    p.add_argument("--buckets", type=int, default=64)
    p.add_argument("--spread", type=int, default=None)
    p.add_argument("--files-per-trigger", type=int, default=FILES_PER_TRIGGER)
    p.add_argument("--checkpoint")
    p.add_argument("--continuous", action="store_true", help="keep polling instead of availableNow")
    p.add_argument("--interval", default="1 minute")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    layout = _layout(args)
    if args.job == "ingest":
        return {"results": ingest_directory(spark, args.landing, layout, _suite(args))}
    if args.job == "stream":
        q = start_ingest(spark, args.landing, layout, checkpoint=args.checkpoint, suite=_suite(args),
                         max_files_per_trigger=args.files_per_trigger, archive_dir=args.archive,
                         available_now=not args.continuous, interval=args.interval)
        q.awaitTermination()
        # The stream archives a batch's files when a later one commits: the rest goes now.
        return {"stream": q.id, **(_archived(spark, args, layout) if args.archive else {})}
    if args.job == "clean":
        return {"rewritten": run_clean_model(spark, layout)}
    if args.job == "models":
        return run_models(spark, layout, args.mart)
    if args.job == "mart":
        materialize_table(yearly_damage(read_upsert_table(spark, args.clean)), args.mart)
        return {"mart": args.mart}
    return _archived(spark, args, layout)


def _archived(spark: SparkSession, args, layout: Layout) -> dict:
    """Numbers of files that were moved and that were not, by reason."""
    moves = archive_loaded(spark, args.landing, args.archive, layout)
    found = {r["error"]: r["count"] for r in moves.groupBy("error").count().collect()}
    return {"archived": found.pop(None, 0), "not_archived": found}


def main() -> None:
    print(json.dumps(run(), default=str))


if __name__ == "__main__":
    main()
