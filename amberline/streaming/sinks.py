"""Sinks as independent streaming queries, each with its own trigger and checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from amberline.operators.decode import json_value
from amberline.operators.views import alerts_view, console_view, results_view
from amberline.schemas import CSV_OPTIONS
from amberline.session import exists

CONSOLE_OPTIONS = {"numRows": "20", "truncate": "false"}
#: Text with line breaks makes a CSV file unsplittable, so files are kept small.
FILE_ROWS = "500000"


def all_columns(scored: DataFrame) -> DataFrame:
    return scored


@dataclass(frozen=True)
class Sink:
    shape: Callable[[DataFrame], DataFrame]
    format: str
    every: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def keeps_files(self) -> bool:
        return self.format != "console"


# Formats and trigger intervals of the four sinks.
SINKS: dict[str, Sink] = {
    "console": Sink(console_view, "console", "10 seconds", CONSOLE_OPTIONS),
    "predictions": Sink(all_columns, "parquet", "30 seconds"),
    "results": Sink(results_view, "csv", "20 seconds", {**CSV_OPTIONS, "maxRecordsPerFile": FILE_ROWS}),
    "alerts": Sink(alerts_view, "json", "5 seconds"),
}
FILE_SINKS = tuple(name for name, sink in SINKS.items() if sink.keeps_files)


def output_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def checkpoint_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/checkpoints/{name}"


def start_sink(
    scored: DataFrame, name: str, base: str, available_now: bool = False
) -> StreamingQuery:
    """Start one sink in append mode; ``available_now`` takes what is there and ends.

    A folder belongs to the checkpoint it was begun with: the sink's log counts batches from 0, so
    another checkpoint, or the fan-out, would have its batches ignored or hidden. That is refused.
    """
    sink = SINKS[name]
    if sink.keeps_files:
        spark, path = scored.sparkSession, output_path(base, name)
        if exists(spark, path) and not exists(spark, checkpoint_path(base, name)):
            raise ValueError(f"{path} holds outputs of another checkpoint; use another base")
    writer = sink.shape(scored).writeStream.outputMode("append").format(sink.format)
    writer = writer.options(**sink.options).queryName(f"{name}:{base}")
    if sink.keeps_files:
        writer = writer.option("path", output_path(base, name)).option(
            "checkpointLocation", checkpoint_path(base, name)
        )
    trigger = {"availableNow": True} if available_now else {"processingTime": sink.every}
    return writer.trigger(**trigger).start()


def start_sinks(
    scored: DataFrame,
    base: str,
    names: Sequence[str] = tuple(SINKS),
    available_now: bool = False,
) -> list[StreamingQuery]:
    """One query per sink. Each reads the source for itself and keeps its own offsets."""
    return [start_sink(scored, name, base, available_now) for name in names]


def start_publisher(
    df: DataFrame, checkpoint: str, options: dict[str, str]
) -> StreamingQuery:
    """Send each row of a stream to a topic as a JSON message."""
    writer = df.select(json_value(df)).writeStream.format("kafka")
    return (
        writer.options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )
