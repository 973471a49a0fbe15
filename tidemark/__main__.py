"""Command line runs of the layers.

    spark-submit ... -m tidemark bronze payments --root s3a://lake --servers broker:9092
    python -m tidemark silver payments --root ./lake
"""

from __future__ import annotations

import argparse
from contextlib import nullcontext
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import report
from tidemark.operators.baseline import flagged_hours, worst_first
from tidemark.operators.envelope import decode
from tidemark.operators.hourly import highest
from tidemark.operators.keys import hot_keys
from tidemark.operators.timeline import payment_trace, timeline_of_log
from tidemark.plans.incremental import IncrementalSilver
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import HOUR, PAYMENTS, STREAMS, StreamSpec
from tidemark.session import build_session
from tidemark.sources.tables import read_table
from tidemark.sources.topics import kafka_options, stream_log_files, stream_topics
from tidemark.streaming.ingest import DEFAULT_INTERVAL, show_feed, start_bronze, start_feed
from tidemark.streaming.watch import ingested_quality, noting_steps, start_key_watch


def preview(title: str, rows: DataFrame, n: int = 20) -> None:
    print(f"\n--- {title} ---")
    rows.show(n, truncate=False)


def open_log(spark: SparkSession, options: argparse.Namespace, topics: list[str]) -> DataFrame:
    if options.log:
        return stream_log_files(spark, options.log, options.max_bytes)
    if not options.servers:
        raise SystemExit("name the brokers with --servers, or files with --log")
    scan = kafka_options(
        options.servers,
        topics,
        max_offsets_per_trigger=options.max_offsets,
        min_partitions=options.min_partitions,
    )
    return stream_topics(spark, scan)


def run_bronze(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    """Appends to Bronze; ``--count-steps`` notes the quality of every batch beside it."""
    notes = lake.path("quality", f"{spec.name}_batches")
    noting = noting_steps(lake.spark, spec, notes) if options.count_steps else nullcontext()
    with noting:
        start_bronze(
            open_log(lake.spark, options, [spec.topic]),
            spec,
            lake.bronze_path(spec),
            lake.checkpoint(spec),
            lake.table_format,
            keep_raw=options.keep_raw,
            interval=None if options.once else options.interval,
            count_steps=options.count_steps,
        ).awaitTermination()
    if options.count_steps:
        preview("Data quality of all batches", ingested_quality(lake.spark, notes))


def run_keys(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    """Keeps the summary of a stream's keys, and shows the hot ones when it ends."""
    path = lake.path("keys", spec.name)
    start_key_watch(
        decode(open_log(lake.spark, options, [spec.topic]), spec),
        spec,
        path,
        lake.path("checkpoints/keys", spec.name),
        lake.table_format,
        None if options.once else options.interval,
    ).awaitTermination()
    found = hot_keys(read_table(lake.spark, path, lake.table_format), spec)
    preview("Hot keys", found.orderBy(found["events"].desc()))


def run_silver(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    if options.incremental:
        summary, title = IncrementalSilver(lake, spec).refresh(), "Days read and rows written"
    else:
        summary, title = lake.refresh_silver(spec), "Data quality"
    preview("Silver sample", lake.silver(spec), 5)
    preview(title, summary)


def run_gold(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    if options.first_date or options.last_date:
        gold = lake.refresh_gold_days(spec, options.first_date, options.last_date)
    else:
        gold = lake.refresh_gold(spec)
    preview("Hourly metrics", gold.orderBy(HOUR, *spec.entities))
    if spec.rates:
        preview(f"Highest {spec.rate}", highest(gold, spec))


def run_baseline(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    """Stores thresholds and flagged hours in full, and shows the first of them."""
    if options.by_days:
        run_baseline_days(lake, spec, options)
        return
    thresholds, flagged = lake.refresh_baseline(spec, options.min_hours, options.percentile)
    preview("Baselines and thresholds", thresholds)
    preview("Hours above their threshold", worst_first(flagged, spec))


def run_baseline_days(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    """Thresholds from stored days, of which those of the range are made anew."""
    days = (options.first_date, options.last_date)
    if options.percentile is None:
        thresholds = lake.refresh_baseline_days(spec, *days, options.min_hours)
    else:
        thresholds = lake.refresh_percentile_days(
            spec, *days, options.percentile, options.min_hours
        )
    flagged = flagged_hours(lake.gold(spec, *days), thresholds, spec)
    preview("Thresholds", thresholds)
    preview("Hours above their threshold", worst_first(flagged, spec))


def run_report(lake: Lakehouse) -> None:
    """Stores every answer in full, and shows the first rows of each."""
    bronze = lake.bronze(PAYMENTS)
    questions = {
        "Payment events stored": report.total_events,
        "Failed payments by merchant": report.failures_by_merchant,
        "Completed volume by currency": report.volume_by_currency,
        "Payments by merchant and status": report.status_breakdown,
    }
    for title, question in questions.items():
        answer = question(bronze)
        lake.store(answer, "report", question.__name__)
        preview(title, answer)


def run_expire(lake: Lakehouse, spec: StreamSpec, options: argparse.Namespace) -> None:
    now = datetime.now(UTC).replace(tzinfo=None).isoformat()
    days = lake.expire_bronze(spec, options.as_of or now)
    print(f"{spec.name}: removed {', '.join(days) or 'nothing'}")


def run_feed(lake: Lakehouse, name: str, lines: DataFrame, options: argparse.Namespace) -> None:
    """Appends the whole feed to a table; ``--preview`` shows some of it instead."""
    interval = None if options.once else options.interval
    if options.preview:
        feed = show_feed(lines, name, options.preview, interval)
    else:
        path = options.out or lake.path("feeds", name)
        checkpoint = lake.path("checkpoints", name)
        feed = start_feed(lines, name, path, checkpoint, lake.table_format, interval)
    feed.awaitTermination()


def run_timeline(lake: Lakehouse, options: argparse.Namespace) -> None:
    log = open_log(lake.spark, options, [spec.topic for spec in STREAMS.values()])
    run_feed(lake, "timeline", timeline_of_log(log), options)


def run_trace(lake: Lakehouse, options: argparse.Namespace) -> None:
    payments = decode(open_log(lake.spark, options, [PAYMENTS.topic]), PAYMENTS)
    run_feed(lake, "trace", payment_trace(payments), options)


def parse_options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    parser.add_argument(
        "layer",
        choices=[
            "bronze", "silver", "gold", "baseline", "report", "timeline", "trace", "expire", "keys"
        ],
    )
    parser.add_argument("stream", nargs="?", choices=sorted(STREAMS), default=PAYMENTS.name)
    parser.add_argument("--root", default="./lake", help="folder of all tables")
    parser.add_argument("--format", default="parquet", help="table format, such as delta")
    parser.add_argument("--packages", help="Maven coordinates of further connectors")
    parser.add_argument("--input-bytes", type=int, help="size of the table to read")
    parser.add_argument("--servers", help="Kafka bootstrap servers, unless there is --log")
    parser.add_argument("--log", help="read log records from parquet files, not from Kafka")
    parser.add_argument("--keep-raw", action="store_true", help="keep undecoded bytes in Bronze")
    parser.add_argument(
        "--count-steps", action="store_true", help="Bronze: note what Silver will keep of a batch"
    )
    parser.add_argument(
        "--by-days", action="store_true", help="baseline: merge days, read those of the range only"
    )
    parser.add_argument("--interval", default=DEFAULT_INTERVAL, help="time between batches")
    parser.add_argument("--max-offsets", type=int, help="most Kafka records per batch")
    parser.add_argument("--min-partitions", type=int, help="fewest tasks per Kafka batch")
    parser.add_argument("--max-bytes", type=int, help="most bytes of log files per batch")
    parser.add_argument("--out", help="table of the feed, if not below the root folder")
    parser.add_argument("--preview", type=int, help="rows of each batch of a feed to show only")
    parser.add_argument(
        "--incremental", action="store_true", help="Silver: read new days of Bronze only"
    )
    parser.add_argument("--first-date", help="first day of Gold to rebuild, or to read")
    parser.add_argument("--last-date", help="last day of Gold to rebuild")
    parser.add_argument("--min-hours", type=int, default=1, help="history that a threshold needs")
    parser.add_argument("--percentile", type=float, help="threshold: this share of the history")
    parser.add_argument("--as-of", help="time from which retention counts, if not now (UTC)")
    parser.add_argument("--once", action="store_true", help="ingest what is there and end")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse_options(arguments)
    spark = build_session(
        f"tidemark-{options.layer}-{options.stream}",
        options.format,
        options.packages,
        options.input_bytes,
    )
    lake = Lakehouse(spark, options.root, options.format)
    spec = STREAMS[options.stream]
    if options.layer == "bronze":
        run_bronze(lake, spec, options)
    elif options.layer == "silver":
        run_silver(lake, spec, options)
    elif options.layer == "gold":
        run_gold(lake, spec, options)
    elif options.layer == "baseline":
        run_baseline(lake, spec, options)
    elif options.layer == "report":
        run_report(lake)
    elif options.layer == "keys":
        run_keys(lake, spec, options)
    elif options.layer == "expire":
        run_expire(lake, spec, options)
    elif options.layer == "timeline":
        run_timeline(lake, options)
    else:
        run_trace(lake, options)


if __name__ == "__main__":
    main()
