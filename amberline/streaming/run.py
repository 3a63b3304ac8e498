"""The streaming job: source, decode, features, score, sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from amberline.operators.decode import parse_transactions
from amberline.operators.features import engineer_features
from amberline.operators.quality import deduplicate, judge_transactions, quarantine
from amberline.operators.scoring import score
from amberline.sources.kafka import read_stream
from amberline.sources.models import load_model
from amberline.streaming.fanout import start_fan_out
from amberline.streaming.sinks import SINKS, checkpoint_path, output_path, start_sinks


@dataclass(frozen=True)
class JobConfig:
    """``base`` holds the output folders and the checkpoints.

    ``fan_out`` runs one query that feeds all ``sinks``; otherwise each of them is a query of its
    own. A base serves one of the two modes. ``dedup_within`` drops repeats of an id that arrive
    that close together, or all of them (``always``). ``quarantine`` keeps messages that cannot be taken apart: each message is
    either scored or there. The fan-out splits its one decode; separate sinks score all and a query
    of its own keeps them.
    """

    base: str
    source: dict[str, str]
    model_path: str | None = None
    fan_out: bool = True
    sinks: Sequence[str] = tuple(SINKS)
    every: str = "5 seconds"
    available_now: bool = False
    dedup_within: str | None = None
    quarantine: bool = False


def scored_stream(spark: SparkSession, config: JobConfig) -> DataFrame:
    # Without dedup the fan-out filters only rows it has written, so its parse needs no guard.
    guard = not config.fan_out or config.dedup_within is not None
    messages = read_stream(spark, config.source)
    split = config.quarantine and config.fan_out
    parsed = judge_transactions(messages) if split else parse_transactions(messages, guard=guard)
    if config.dedup_within:
        parsed = deduplicate(parsed, config.dedup_within)
    model = load_model(config.model_path) if config.model_path else None
    return score(engineer_features(parsed), model)


def start_quarantine(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Messages that cannot be taken, with the reason, as JSON lines under ``quarantine``."""
    writer = quarantine(read_stream(spark, config.source)).writeStream.outputMode("append").format("json")
    trigger = {"availableNow": True} if config.available_now else {"processingTime": config.every}
    return (
        writer.option("path", output_path(config.base, "quarantine"))
        .option("checkpointLocation", checkpoint_path(config.base, "quarantine"))
        .trigger(**trigger)
        .start()
    )


def start_job(spark: SparkSession, config: JobConfig) -> list[StreamingQuery]:
    scored = scored_stream(spark, config)
    if config.fan_out:
        return [start_fan_out(scored, config.base, config.every, config.available_now, config.sinks)]
    queries = start_sinks(scored, config.base, config.sinks, config.available_now)
    return [*queries, start_quarantine(spark, config)] if config.quarantine else queries


def wait_for(queries: Sequence[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until all queries end. When one fails the others are stopped and its error is raised."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(poll_seconds)
        for query in queries:
            query.awaitTermination(poll_seconds)
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            query.stop()


def run_job(spark: SparkSession, config: JobConfig) -> None:
    wait_for(start_job(spark, config))
