"""Turn many small batch folders into few well-sized files per arrival date, a piece at a time.

``<name>_daily/chunk=<id>/arrival_date=<day>`` holds the rows of one compaction; ``<name>_done``
says, once they are written, up to which batch of which run they reach, and when. Readers take the
chunks that are listed there and the batches after them, so every row is read once, also while a
compaction runs or after one that failed.

Within a day rows are dealt and sorted by range of ``transaction_id``, with Bloom filters in the
files, so that a lookup by id reads few row groups. ``reclaim`` deletes batch folders that a chunk
has held for longer than any reader of them may still run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.session import exists, listed, remove
from amberline.sources.files import read_alerts, read_predictions, read_results
from amberline.streaming import commits
from amberline.streaming.state import KEYS, SKETCHES, STATE, SUMS, merged, read_state
from amberline.streaming.sinks import output_path

Reader = Callable[..., DataFrame]
_DONE = "chunk string, run string, last_batch int, listed_at timestamp"
# The time of arrival in each kind of output.
KINDS: dict[str, tuple[Reader, str]] = {"predictions": (read_predictions, "kafka_timestamp"), "alerts": (read_alerts, "alert_time")}


def done_rows(spark: SparkSession, base: str, name: str) -> list:
    path = f"{output_path(base, name)}_done"
    return spark.read.schema(_DONE).json(path).collect() if exists(spark, path) else []  # a row for each run and compaction


def reached(done: list) -> dict[str, int]:
    last: dict[str, int] = {}
    for row in done:
        last[row.run] = max(row.last_batch, last.get(row.run, -1))
    return last


def after(last: dict[str, int]) -> str:
    """A condition on folder columns: batches that no chunk holds."""
    known = [f"(run = '{run}' AND batch_id <= {batch})" for run, batch in sorted(last.items())]
    return f"NOT ({' OR '.join(known)})" if known else "true"


def compact(spark: SparkSession, base: str, name: str = "predictions", keep: int = 1) -> str | None:
    """Compact the batches that no earlier compaction has taken; the newest ``keep`` of each run are left.

    Only complete batches are taken. Returns the chunk's name, or None when there was nothing to do. Ranges
    of arrival date and id are of like size whatever the dates hold, and adaptive execution joins small ones.
    """
    reader, arrival = KINDS[name]
    rows = reader(spark, output_path(base, name), partitions=["run", "batch_id"])
    rows, ends = _to_take(spark, base, name, keep, rows)
    if not ends:
        return None
    rows = rows.drop("run", "batch_id").withColumn("arrival_date", F.to_date(arrival))
    chunk = uuid.uuid4().hex
    target = f"{output_path(base, name)}_daily/chunk={chunk}"
    rows = rows.repartitionByRange("arrival_date", "transaction_id").sortWithinPartitions("arrival_date", "transaction_id")
    rows.write.partitionBy("arrival_date").options(**{"parquet.bloom.filter.enabled#transaction_id": "true"}).parquet(target)
    _list(spark, base, name, chunk, ends)
    return chunk


def compact_state(spark: SparkSession, base: str, keep: int = 1) -> str | None:
    """Merge the states that no earlier compaction has taken into one; as ``compact``."""
    path = output_path(base, "state")
    if not exists(spark, path):
        return None
    rows = spark.read.schema(f"{STATE}, run string, batch_id int").parquet(path)
    rows, ends = _to_take(spark, base, "state", keep, rows)
    if not ends:
        return None
    chunk = uuid.uuid4().hex
    merged(rows.select(*KEYS, *SUMS, *SKETCHES)).write.parquet(f"{path}_daily/chunk={chunk}")
    _list(spark, base, "state", chunk, ends)
    return chunk


def _to_take(spark: SparkSession, base: str, name: str, keep: int, rows: DataFrame) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The rows of complete batches that are to be taken, and each run's last such batch."""
    before = reached(done_rows(spark, base, name))
    rows = rows.where(after(before)).where(commits.complete(commits.committed(spark, base)))
    newest = rows.groupBy("run").agg(F.max("batch_id").alias("last")).collect()
    ends = [(r.run, r.last - keep) for r in newest if r.last is not None and r.last - keep > before.get(r.run, -1)]
    taken = " OR ".join(f"(run = '{run}' AND batch_id <= {last})" for run, last in ends)
    return rows.where(taken or "false"), ends


def _list(spark: SparkSession, base: str, name: str, chunk: str, ends: list[tuple[str, int]]) -> None:
    marks = spark.createDataFrame([(chunk, run, last, datetime.now(UTC)) for run, last in ends], _DONE)
    marks.coalesce(1).write.mode("append").json(f"{output_path(base, name)}_done")


def reclaim(spark: SparkSession, base: str, name: str = "predictions", grace: timedelta = timedelta(hours=1)) -> int:
    """Delete the batch folders whose rows a chunk has held for ``grace`` or longer; how many were deleted.

    ``grace`` is the longest time that a reader may take: one that began before the chunk was listed reads
    the folders, later ones the chunk. Batches that are written again after a failure were not complete, so
    no chunk holds them. Listing the folder then costs as much as the batches since the last chunks.
    """
    before = datetime.now(UTC) - grace
    old = [row for row in done_rows(spark, base, name) if row.listed_at is not None and row.listed_at.astimezone(UTC) <= before]
    deleted = 0
    for run, last in reached(old).items():
        for batch in batches_of(spark, base, name, run):
            if batch <= last:
                remove(spark, f"{output_path(base, name)}/run={run}/batch_id={batch}")
                deleted += 1
    return deleted


def batches_of(spark: SparkSession, base: str, name: str, run: str) -> list[int]:
    """The batches of a run that have a folder of an output."""
    folder = f"{output_path(base, name)}/run={run}"
    found = [entry.rpartition("=")[2] for entry in listed(spark, folder) if entry.startswith("batch_id=")]
    return sorted(int(batch) for batch in found)


@dataclass(frozen=True)
class Snapshot:
    """All outputs as they stood together at one moment: batches complete by then, and what of them was compacted.

    Readers of one snapshot agree on the batches, whatever is written or compacted meanwhile.
    """

    spark: SparkSession
    base: str
    done: dict[str, list]
    last: dict[str, int]

    def rows(self, name: str, since: str | None = None, until: str | None = None) -> DataFrame:
        """Predictions or alerts, as ``read_compacted``."""
        return read_compacted(self.spark, self.base, name, since, until, self)

    def results(self) -> DataFrame:
        rows = read_results(self.spark, output_path(self.base, "results"), partitions=["run", "batch_id"])
        return rows.where(commits.complete(self.last)).drop("run", "batch_id")

    def state(self) -> DataFrame | None:
        return read_state(self.spark, self.base, self.last, self.done["state"])


def take_snapshot(spark: SparkSession, base: str) -> Snapshot:
    """What was compacted is looked up first: all of it is complete when the batches are."""
    done = {name: done_rows(spark, base, name) for name in (*KINDS, "state")}
    return Snapshot(spark, base, done, commits.committed(spark, base))


def read_compacted(
    spark: SparkSession, base: str, name: str = "predictions", since: str | None = None, until: str | None = None, snapshot: Snapshot | None = None
) -> DataFrame:
    """All rows of complete batches of an output, compacted or not; ``since`` and ``until`` (dates, both included) prune compacted folders."""
    reader, arrival = KINDS[name]
    snapshot = snapshot or take_snapshot(spark, base)
    done = snapshot.done[name]
    rest = reader(spark, output_path(base, name), partitions=["run", "batch_id"])
    rest = rest.where(after(reached(done))).where(commits.complete(snapshot.last)).drop("run", "batch_id")
    rest = rest.withColumn("arrival_date", F.to_date(arrival))
    rows = rest
    if done:
        chunks = sorted({row.chunk for row in done})
        path = f"{output_path(base, name)}_daily"
        files = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rest.schema)}, chunk string").parquet(path)
        rows = files.where(F.col("chunk").isin(chunks)).drop("chunk").unionByName(rest)
    if since:
        rows = rows.where(f"arrival_date >= DATE '{since}'")
    if until:
        rows = rows.where(f"arrival_date <= DATE '{until}'")
    return rows.drop("arrival_date")
