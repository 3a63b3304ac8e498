"""Running totals in arrival order, exact and without a single-task window.

1. Rows are range-partitioned on (time, id, label) into slots and sorted there. A message
   repeated so often that it would fill a slot is first counted to one row (see ``_with_copies``).
2. One Arrow pass per slot adds the running totals inside the slot and joins neighbours of
   equal label into runs, along which the totals grow evenly. The runs, a few integers each,
   are written to the shared scratch folder, so slots cannot change between their two uses.
3. The slots' totals (one row per slot) give every slot its start; runs that cross a multiple
   of ``every`` are then expanded, the long ones in chunks spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import flag, percent
from amberline.session import scratch_path

CHUNK = 100_000
HEAVY_ROWS = 100_000
BUCKETS_PER_SLOT = 16
_KEY = ("kafka_timestamp", "transaction_id", "label")
_RUN = "copies bigint, label int, seen bigint, fraud bigint"


def _run_finder() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The Arrow pass: sorted (copies, label) rows to runs of one label, with the totals at their end.

    It is an inner function so that it travels to the workers whole; they need not have this
    library installed.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = fraud = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            copies = batch.column("copies").to_numpy()
            label = batch.column("label").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(label)), len(label) - 1)
            seen_at = np.cumsum(copies)[ends] + seen
            fraud_at = np.cumsum(copies * label)[ends] + fraud
            length = np.diff(seen_at, prepend=seen)
            seen, fraud = int(seen_at[-1]), int(fraud_at[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in (length, label[ends], seen_at, fraud_at)],
                names=["copies", "label", "seen", "fraud"],
            )

    return runs


def _with_copies(rows: DataFrame, slots: int) -> DataFrame:
    """The rows with ``copies``, how many equal rows each stands for.

    Rows are counted by a hash of their key into a fixed number of buckets, which is cheap. Only
    a bucket above half a slot's share can hold a message repeated that often; the rows of such
    buckets, at most two per slot, are grouped, which counts copies before the shuffle. All
    others stand for themselves.
    """
    bucket = F.expr(f"pmod(xxhash64({', '.join(_KEY)}), {BUCKETS_PER_SLOT * slots})")
    sizes = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    large = sizes.selectExpr("bucket", "n", "sum(n) OVER () AS total").where(
        f"n > {HEAVY_ROWS} AND n * {2 * slots} > total"
    )
    heavy = [row.bucket for row in large.select("bucket").collect()]
    single = rows.withColumn("copies", F.lit(1).cast("bigint"))
    if not heavy:
        return single
    grouped = rows.where(bucket.isin(heavy)).groupBy(*_KEY).agg(F.count("*").alias("copies"))
    return single.where(~bucket.isin(heavy)).unionByName(grouped)


def running_fraud_rate(
    df: DataFrame,
    every: int = 50,
    start: tuple[int, int] = (0, 0),
    partitions: int | None = None,
    work: str | None = None,
) -> DataFrame:
    """Transactions and labelled frauds seen so far, at every ``every``-th row and at the end.

    Order is (kafka_timestamp, transaction_id, label). ``start`` is the (transactions, frauds)
    seen before this frame, so a stream can carry on from batch to batch. The result reads
    intermediate data in ``work``, by default a fresh scratch folder. Batch frames only;
    the frame is read three times (bucket sizes, range bounds, rows), three columns each.
    """
    spark = df.sparkSession
    slots = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.selectExpr("kafka_timestamp", "transaction_id", f"{flag('is_fraud = 1')} AS label")
    path = work or scratch_path(spark, "running")
    (
        _with_copies(rows, slots)
        .repartitionByRange(slots, *_KEY)
        .sortWithinPartitions(*_KEY)
        .select("copies", "label")
        .mapInArrow(_run_finder(), _RUN)
        .select(F.spark_partition_id().alias("slot"), "*")
        .write.mode("overwrite").parquet(path)
    )
    runs = spark.read.schema(f"slot int, {_RUN}").parquet(path)

    # One row per slot, so this single-task window sorts at most ``slots`` rows.
    totals = runs.groupBy("slot").agg(F.max("seen").alias("slot_seen"), F.max("fraud").alias("slot_fraud"))
    before = "OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = totals.selectExpr(
        "slot",
        f"coalesce(sum(slot_seen) {before}, 0) + {start[0]} AS seen_before",
        f"coalesce(sum(slot_fraud) {before}, 0) + {start[1]} AS fraud_before",
    )
    # A run covers the positions (seen - copies, seen].
    crossing = (
        runs.join(F.broadcast(starts), "slot")
        .selectExpr("copies", "label", "seen + seen_before AS seen", "fraud + fraud_before AS fraud")
        .selectExpr(
            "label",
            "seen",
            "fraud",
            f"(seen - copies) DIV {every} + 1 AS first",
            f"seen DIV {every} AS last",
        )
        .where("first <= last")
    )
    short = crossing.where(f"last - first < {CHUNK}")
    long = (
        crossing.where(f"last - first >= {CHUNK}")
        .withColumn("first", F.expr(f"explode(sequence(first, last, {CHUNK}L))"))
        .withColumn("last", F.expr(f"least(last, first + {CHUNK - 1})"))
        .repartition(slots, "first")
    )
    milestones = short.unionByName(long).selectExpr(
        "label", "seen", "fraud", f"explode(sequence(first * {every}, last * {every}, {every}L)) AS transactions"
    )
    reported = milestones.selectExpr(
        "transactions", "fraud - (seen - transactions) * label AS frauds", "false AS is_final"
    )
    final = totals.selectExpr(
        f"coalesce(sum(slot_seen), 0) + {start[0]} AS transactions",
        f"coalesce(sum(slot_fraud), 0) + {start[1]} AS frauds",
        "true AS is_final",
    )
    return reported.unionByName(final).selectExpr(
        "transactions", "frauds", f"{percent('frauds', 'transactions')} AS fraud_rate", "is_final"
    )
