"""Command line: the streaming job, the model build + checks, the load job.

    python -m meterlake stream --log-dir DIR --out DIR [--mode chained|fanout|one_parse]
                               [--trigger availableNow|"30 seconds"] [--timeout SEC]
    python -m meterlake stream --brokers HOST:PORT --topic T --out DIR ...
    python -m meterlake models --source PARQUET_DIR | --source-table NAME --out DIR [--full-refresh] [--no-gate]
                               [--delivery NAME] [--late ignore|merge]
    python -m meterlake compact --out DIR (of stream --mode one_parse, or of models)
    python -m meterlake load --silver DIR --table NAME [--location DIR]

Each command prints a short summary (row counts, preview, check results);
the work itself runs on the cluster.
"""

from __future__ import annotations

import argparse
import sys

from meterlake.config import build_session
from meterlake.operators import quality, reports
from meterlake.plans import job
from meterlake.plans.increments import Warehouse
from meterlake.schemas import READINGS_TOPIC
from meterlake.sinks import warehouse
from meterlake.sinks.manifest import Manifest
from meterlake.sources.log import read_envelope_files, read_log
from meterlake.sources.tables import read_written, source_table
from meterlake.streaming import layers
from meterlake.streaming.one_parse import OneParse


def _stream(args, spark) -> int:
    if args.brokers:
        # A bounded run takes what is on the log; a live one starts with what comes.
        offsets = args.starting_offsets or ("earliest" if args.trigger == "availableNow" else "latest")
        envelope = read_log(spark, args.brokers, args.topic, offsets)
    else:
        envelope = read_envelope_files(spark, args.log_dir, max_files_per_trigger=args.max_files_per_trigger)
    paths = layers.LayerPaths(args.out)
    trigger = args.trigger or ("30 seconds" if args.brokers else "availableNow")
    trigger = None if trigger == "default" else trigger
    if args.mode == "one_parse":
        out = OneParse(spark, args.out)
        query = out.start(envelope, trigger)
        if trigger in ("availableNow", "once"):
            query.awaitTermination()
        else:
            layers.run_bounded({"one_parse": query}, args.timeout)
        tables = {name: out.read(name) for name in ("bronze", "silver", "gold", "late")}
        reports.layer_counts(tables).show(truncate=False)
        reports.gold_preview(tables["gold"]).show(truncate=False)
        return 0
    started = layers.start_medallion(
        spark,
        envelope,
        paths,
        mode=args.mode,
        trigger=trigger,
        gold_state_partitions=args.gold_state_partitions,
        date_partitions=args.date_partitions,
        min_batches_to_retain=args.min_batches_to_retain,
    )
    if trigger not in ("availableNow", "once"):
        layers.run_bounded(started, args.timeout)
    schemas = {"bronze": layers.BRONZE_SCHEMA, "silver": layers.SILVER_SCHEMA, "gold": layers.GOLD_SCHEMA}
    tables = {name: read_written(spark, paths.table(name), schema) for name, schema in schemas.items()}
    reports.layer_counts(tables).show(truncate=False)
    reports.gold_preview(tables["gold"]).show(truncate=False)
    return 0


def _models(args, spark) -> int:
    source = source_table(spark, args.source_table) if args.source_table else spark.read.parquet(args.source)
    try:
        result = job.run_then_test(spark, source, args.out, args.full_refresh, fail_on_error=not args.no_gate,
                                   delivery=args.delivery, late=args.late)
    except quality.DataQualityError as error:
        print(f"not published: {error}")
        return 1
    print(f"fact run: {result.fact_run.mode} (high-water mark {result.fact_run.high_water_mark})")
    if result.checks is None:
        print(f"delivery {args.delivery} was published before")
        return 0
    result.checks.orderBy("model", "column_name", "check_type").show(50, truncate=False)
    return 0


def _compact(args, spark) -> int:
    """Merge the small parts of whichever table folder this is."""
    state = Manifest(spark, args.out).current()[1]
    if not state:
        print(f"nothing was published below {args.out}")
        return 1
    table = Warehouse(spark, args.out) if "hours" in state else OneParse(spark, args.out)
    print(f"state {table.compact()}")
    return 0


def _load(args, spark) -> int:
    result = warehouse.load_silver(spark, args.silver, args.table, args.location)
    print(f"loaded {result.rows_loaded} rows into {result.table}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="meterlake")
    parser.add_argument("--master", default=None)
    sub = parser.add_subparsers(dest="command", required=True)

    s = sub.add_parser("stream", help="bronze / silver / gold streaming layers")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--log-dir")
    src.add_argument("--brokers")
    s.add_argument("--topic", default=READINGS_TOPIC)
    s.add_argument("--starting-offsets", default=None)
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", choices=["chained", "fanout", "one_parse"], default="chained")
    s.add_argument("--trigger", default=None)
    s.add_argument("--min-batches-to-retain", type=int, default=None)
    s.add_argument("--timeout", type=float, default=600.0)
    s.add_argument("--gold-state-partitions", type=int, default=None)
    s.add_argument("--date-partitions", action="store_true")

    m = sub.add_parser("models", help="build the marts, then run the 20 checks")
    given = m.add_mutually_exclusive_group(required=True)
    given.add_argument("--source")
    given.add_argument("--source-table")
    m.add_argument("--out", required=True)
    m.add_argument("--full-refresh", action="store_true")
    m.add_argument("--no-gate", action="store_true")
    m.add_argument("--delivery", default=None, help="name of a delivery of new readings (it is published only if its checks pass)")
    m.add_argument("--late", choices=["ignore", "merge"], default="ignore")

    c = sub.add_parser("compact", help="merge the small parts of a table folder")
    c.add_argument("--out", required=True)

    ld = sub.add_parser("load", help="load the silver layer into a typed table")
    ld.add_argument("--silver", required=True)
    ld.add_argument("--table", required=True)
    ld.add_argument("--location", default=None)

    args = parser.parse_args(argv)
    spark = build_session(args.master)
    return {"stream": _stream, "models": _models, "compact": _compact, "load": _load}[args.command](args, spark)


if __name__ == "__main__":
    sys.exit(main())
