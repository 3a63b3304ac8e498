"""Command line: ``stream`` runs the scoring job, ``report`` prints figures over its outputs,
``compact`` rewrites small files, ``replay`` scores a whole topic or message folder once, ``train``
fits a model on labelled rows and chooses its threshold."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from amberline.operators import report, views
from amberline.operators.decode import parse_transactions
from amberline.operators.features import engineer_features
from amberline.operators.scoring import decision_threshold, score, train_and_evaluate
from amberline.session import build_session
from amberline.sources.files import unread_files
from amberline.sources.kafka import (
    MAX_PER_TRIGGER,
    TOPIC,
    read_batch,
    replay_options,
    stream_options,
)
from amberline.sources.models import load_model
from amberline.streaming import compaction, state
from amberline.streaming.compaction import KINDS, take_snapshot
from amberline.streaming.monitor import LagListener
from amberline.streaming.run import JobConfig, run_job
from amberline.streaming.sinks import SINKS, output_path

CHARTS_EVERY = 5


def _source(args: argparse.Namespace, options: Callable[..., dict[str, str]], *more) -> dict[str, str]:
    if args.messages:
        return {"format": args.format, "path": args.messages}
    if not args.servers:
        raise SystemExit("give --servers, or --messages for message files")
    return options(args.servers, args.topic, *more)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    wanted = [name for name in args.sinks.split(",") if not (args.no_console and name == "console")]
    config = JobConfig(
        base=args.base,
        source=_source(args, stream_options, args.starting, args.max_per_trigger, args.min_partitions),
        model_path=args.model,
        fan_out=not args.separate,
        sinks=tuple(wanted),
        every=args.every,
        available_now=args.once,
        dedup_within=args.dedup_within,
        quarantine=args.quarantine,
    )
    listener = LagListener(spark, output_path(args.base, "lag"))
    if args.lag:
        spark.streams.addListener(listener)
    try:
        run_job(spark, config)
    finally:
        if args.lag:
            spark.streams.removeListener(listener)
            listener.flush()


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = read_batch(spark, _source(args, replay_options, args.min_partitions))
    model = load_model(args.model) if args.model else None
    scored = score(engineer_features(parse_transactions(messages, guard=False)), model)
    scored.write.mode("overwrite").parquet(output_path(args.base, "replay"))


def show_report(
    spark: SparkSession,
    base: str,
    charts: bool,
    kind: str = "parquet",
    since: str | None = None,
    until: str | None = None,
    waits: bool = False,
) -> None:
    """Parquet holds the same rows as the CSV folder, and lets each figure read its columns only.

    All is read at one snapshot of complete batches. Compacted days are read instead of the batches they
    hold; ``since`` and ``until`` prune them. Without these, totals come from the states of the batches.
    """
    snapshot = take_snapshot(spark, base)
    if kind == "csv":
        results = snapshot.results().where(_between("processed_time", since, until))
    else:
        results = views.results_view(snapshot.rows("predictions", since, until))
    alerts = snapshot.rows("alerts", since, until)
    totals, source = (state, snapshot.state()) if kind == "parquet" and not since and not until else (report, None)
    if source is None:
        totals, source = report, results
    for name in ("results", "alerts"):
        skipped = unread_files(spark, output_path(base, name))
        if kind == "csv" or name == "alerts":
            for row in skipped.toLocalIterator():
                print(f"unreadable, skipped: {row.file} ({row.length} bytes)")
    totals.summary(source).show(vertical=True, truncate=False)
    latest = views.recent_alerts(alerts, with_total=True)
    views.alert_card(latest).show(truncate=False)
    latest.selectExpr("coalesce(max(total_alerts), 0) AS total_alerts").show()
    if charts:
        totals.class_split(source).show()
        report.amount_histogram(results).orderBy("bin", "is_fraud_predicted").show(60)
        report.probability_histogram(results).orderBy("bin").show()
        totals.amount_buckets(source).orderBy("bucket_no").show()
        totals.top_locations(source).show(truncate=False)
        views.recent_transactions(results).show(truncate=False)
    if waits and snapshot.state() is not None:
        state.waits(snapshot.state(), "1 hour").orderBy(F.desc("window_start")).show(24, truncate=False)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fit on the messages given, or else on the scored rows of the base, and save the model with its threshold."""
    if args.messages or args.servers:
        messages = read_batch(spark, _source(args, replay_options, args.min_partitions))
        rows = engineer_features(parse_transactions(messages))
    else:
        rows = take_snapshot(spark, args.base).rows("predictions", getattr(args, "from"), args.to)
    model, figures = train_and_evaluate(rows, holdout=args.holdout, least_precision=args.precision)
    writer = model.write().overwrite() if args.overwrite else model.write()
    writer.save(args.model)
    figures.show(truncate=False)
    print(f"threshold {decision_threshold(model)!r}, model saved in {args.model}")


def _between(column: str, since: str | None, until: str | None) -> str:
    ends = [f"to_date({column}) >= DATE '{since}'"] if since else []
    ends += [f"to_date({column}) <= DATE '{until}'"] if until else []
    return " AND ".join(ends) or "true"


def report_loop(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print the report ``times`` times; the distributions on the first and every fifth after it."""
    for turn in range(args.times):
        if turn:
            time.sleep(args.refresh)
        show_report(spark, args.base, turn % CHARTS_EVERY == 0, args.results, getattr(args, "from"), args.to, args.waits)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    for name in KINDS:
        chunk = compaction.compact(spark, args.base, name, args.keep)
        print(f"{name}: {chunk or 'nothing to compact'}")
        if args.reclaim_after is not None:
            print(f"{name}: {compaction.reclaim(spark, args.base, name, timedelta(hours=args.reclaim_after))} batch folders deleted")
    print(f"state: {compaction.compact_state(spark, args.base, args.keep) or 'nothing to compact'}")
    if args.reclaim_after is not None:
        print(f"state: {compaction.reclaim(spark, args.base, 'state', timedelta(hours=args.reclaim_after))} batch folders deleted")


def _days(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("--from", help="first day of arrival, as 2024-01-31")
    sub.add_argument("--to", help="last day of arrival")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="amberline")
    root.add_argument("--master")
    commands = root.add_subparsers(required=True)

    def command(name, run):
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--base", required=True, help="folder of outputs and checkpoints")
        return sub

    for name, run in (("stream", stream), ("replay", replay), ("train", train)):
        sub = command(name, run)
        sub.add_argument("--servers", help="addresses of the topic's brokers")
        sub.add_argument("--topic", default=TOPIC)
        sub.add_argument("--messages", help="read message files from this folder instead of a topic")
        sub.add_argument("--format", default="parquet", help="format of the message files")
        sub.add_argument("--model", required=name == "train", help="folder of a fitted pipeline")
        sub.add_argument("--min-partitions", type=int, help="split the topic into at least this many tasks")
        if name == "train":
            sub.add_argument("--holdout", type=int, default=20, help="percentage of ids that choose the threshold")
            sub.add_argument("--precision", type=float, help="least precision; without it the best f1 counts")
            sub.add_argument("--overwrite", action="store_true", help="replace the model that is there")
            _days(sub)
        if name == "stream":
            sub.add_argument("--starting", default="latest", choices=["latest", "earliest"])
            sub.add_argument("--max-per-trigger", type=int, default=MAX_PER_TRIGGER)
            sub.add_argument("--lag", action="store_true", help="record how far the topic is ahead")
            sub.add_argument("--separate", action="store_true", help="one query per sink")
            sub.add_argument("--sinks", default=",".join(SINKS), help="outputs, separated by commas")
            sub.add_argument("--no-console", action="store_true")
            sub.add_argument("--every", default="5 seconds", help="trigger interval of the one query")
            sub.add_argument("--quarantine", action="store_true", help="keep messages that cannot be taken")
            sub.add_argument("--once", action="store_true", help="take what is there and end")
            sub.add_argument("--dedup-within", help="drop repeats of an id this close together, or always")
    sub = command("report", report_loop)
    sub.add_argument("--results", choices=["parquet", "csv"], default="parquet")
    sub.add_argument("--times", type=int, default=1)
    sub.add_argument("--waits", action="store_true", help="how long rows waited, per hour of writing")
    sub.add_argument("--refresh", type=int, default=20, help="seconds between reports")
    _days(sub)
    sub = command("compact", compact)
    sub.add_argument("--keep", type=int, default=1, help="newest batches of each run to leave as they are")
    sub.add_argument("--reclaim-after", type=float, help="delete compacted batch folders after so many hours")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(master=args.master), args)


if __name__ == "__main__":
    main()
