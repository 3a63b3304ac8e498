"""All sinks from one streaming query: one read, one scoring, outputs that agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from amberline.operators.quality import refused
from amberline.operators.views import alerts_view, console_view, results_view
from amberline.schemas import CSV_OPTIONS, SCORED, names, struct
from amberline.session import exists
from amberline.streaming import commits
from amberline.streaming.state import batch_state, counted, waited
from amberline.streaming.sinks import CONSOLE_OPTIONS, FILE_ROWS, FILE_SINKS, SINKS, checkpoint_path, output_path


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch is of; it lives as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_batch(batch: DataFrame, batch_id: int, base: str, sinks: Sequence[str] = FILE_SINKS) -> None:
    """Write one micro-batch to the named sinks, under ``run=<query id>/batch_id=<n>``.

    The scored rows are computed once, into Parquet; alerts come next and then results, both
    derived from those files, reading only their columns, and last the batch's part of the report's
    figures. When all are written the batch is marked as complete. One that is run again before that
    overwrites its own folders; after it, there is nothing to do. Batch numbers start again with a
    new checkpoint, which is a new query and so a new ``run``.

    Where rows hold a ``_reason``, those that have one go to ``quarantine`` and nowhere else: one decode
    is kept while both parts are written, and the counts of the batch are taken on its way.
    """
    run, spark = run_of(batch), batch.sparkSession
    if not commits.begin(spark, base, run, batch_id):
        return

    def folder(name: str) -> str:
        return f"{output_path(base, name)}/run={run}/batch_id={batch_id}"

    if "_reason" in batch.columns:
        counts = _write_split(batch, folder)
    else:
        batch.write.mode("overwrite").parquet(folder("predictions"))
        counts = None
    written = spark.read.schema(struct(SCORED)).parquet(folder("predictions"))
    if "alerts" in sinks:
        alerts_view(written).write.mode("overwrite").json(folder("alerts"))
    if "results" in sinks:
        results = results_view(written).write.mode("overwrite")
        results.options(**CSV_OPTIONS, maxRecordsPerFile=FILE_ROWS).csv(folder("results"))
    figures = batch_state(written).unionByName(waited(written))
    figures = figures if counts is None else figures.unionByName(counted(spark, *counts))
    figures.write.mode("overwrite").parquet(folder("state"))
    commits.commit(spark, base, run, batch_id)
    if "console" in sinks:
        console_view(written).show(int(CONSOLE_OPTIONS["numRows"]), truncate=False)


def _write_split(batch: DataFrame, folder) -> tuple[int, int]:
    """Sound rows to ``predictions``, others to ``quarantine``; how many messages there were, and how many were refused."""
    kept, seen = batch.persist(), Observation("intake")
    try:
        watched = kept.observe(seen, F.count("*").alias("messages"), F.count("_reason").alias("refused"))
        watched.where("_reason IS NULL").select(*names(SCORED)).write.mode("overwrite").parquet(folder("predictions"))
        found = seen.get
        refused(kept).write.mode("overwrite").json(folder("quarantine"))
    finally:
        kept.unpersist()
    return found["messages"], found["refused"]


def start_fan_out(
    scored: DataFrame,
    base: str,
    every: str = "5 seconds",
    available_now: bool = False,
    sinks: Sequence[str] = tuple(SINKS),
) -> StreamingQuery:
    """Start the query. Alerts go out every ``every``, without waiting for results or the console."""
    for name in FILE_SINKS:
        if exists(scored.sparkSession, f"{output_path(base, name)}/_spark_metadata"):
            raise ValueError(f"{base} holds outputs of separate sinks, whose log would hide others; use another base")
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        scored.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, base, sinks))
        .option("checkpointLocation", checkpoint_path(base, "fan_out"))
        .trigger(**trigger)
        .start()
    )
