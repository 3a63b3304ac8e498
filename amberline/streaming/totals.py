"""Running fraud rate over a stream, carried from batch to batch.

Rows that come within ``late`` of the newest arrival time wait until no earlier one is expected: they
are kept as a table with the batch, so their number is bounded by the storage only, and a restart finds
them. A row later than that is not lost; it is counted with the batch it comes in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from amberline.operators.running import running_fraud_rate
from amberline.session import exists, listed, remove
from amberline.streaming.fanout import run_of
from amberline.streaming.sinks import checkpoint_path, output_path


NARROW = "kafka_timestamp timestamp, transaction_id string, is_fraud int"


def write_running_batch(batch: DataFrame, batch_id: int, base: str, every: int = 50, late: str | None = None) -> None:
    """Write the milestones of the rows whose order is final with this batch, going on from the batch before.

    A batch run again after a failure reads only the earlier batch and overwrites its own folders.
    Intermediate data lies below ``_work``, outside what readers see, until the milestones are written.
    """
    path, run, spark = output_path(base, "running"), run_of(batch), batch.sparkSession
    start = _reached(spark, f"{path}/run={run}/batch_id={batch_id - 1}") if batch_id > 0 else (0, 0)
    work = f"{path}/_work/run={run}/batch_id={batch_id}"
    rows = batch.select("kafka_timestamp", "transaction_id", "is_fraud")
    waiting = f"{path}/_waiting/run={run}/batch_id="
    if late is not None and exists(spark, f"{waiting}{batch_id - 1}"):
        rows = rows.unionByName(spark.read.schema(NARROW).parquet(f"{waiting}{batch_id - 1}"))
    rows = rows.persist()
    try:
        final = rows
        if late is not None:
            # The newest row always waits, so the rows that wait hold the watermark too.
            newest = rows.agg(F.max("kafka_timestamp").alias("newest"))
            placed = rows.join(F.broadcast(newest)).selectExpr(*rows.columns, f"coalesce(kafka_timestamp >= newest - INTERVAL {late}, false) AS waits")
            placed.where("waits").drop("waits").write.mode("overwrite").parquet(f"{waiting}{batch_id}")
            final = placed.where("NOT waits").drop("waits")
        milestones = running_fraud_rate(final, every, start, work=work)
        milestones.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")
    finally:
        rows.unpersist()
        remove(spark, work)
    if late is not None and batch_id > 1:
        remove(spark, f"{waiting}{batch_id - 2}")  # the batch before may still be what a repeat of this one reads


def _reached(spark: SparkSession, folder: str) -> tuple[int, int]:
    last = spark.read.parquet(folder).where("is_final").first()
    return last["transactions"], last["frauds"]


def waiting_rate(spark: SparkSession, base: str, run: str, every: int = 50) -> DataFrame:
    """The milestones of a run's rows that still wait, as if nothing came before them any more; writes nothing.

    With those written they are the milestones of all rows. For a stream that has ended, or a view of one that runs.
    """
    path = output_path(base, "running")
    done = [int(name.rpartition("=")[2]) for name in listed(spark, f"{path}/run={run}") if name.startswith("batch_id=")]
    if not done:
        raise ValueError(f"{path} holds no batch of run {run}")
    rows = spark.createDataFrame([], NARROW)
    folder = f"{path}/_waiting/run={run}/batch_id={max(done)}"
    if exists(spark, folder):
        rows = spark.read.schema(NARROW).parquet(folder)
    return running_fraud_rate(rows, every, _reached(spark, f"{path}/run={run}/batch_id={max(done)}"))


def start_running_rate(
    parsed: DataFrame, base: str, every: int = 50, interval: str = "10 seconds", available_now: bool = False, late: str | None = None
) -> StreamingQuery:
    """``late``, as ``10 MINUTES``, is how far behind the newest arrival a row may come and still be counted in its order."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        parsed.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_running_batch(batch, batch_id, base, every, late))
        .option("checkpointLocation", checkpoint_path(base, "running"))
        .trigger(**trigger)
        .start()
    )
