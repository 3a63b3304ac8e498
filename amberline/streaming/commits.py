"""Which micro-batches are complete, so that all outputs are read at one version.

``commits/<run>.json`` names the last batch of a run whose outputs are all written. It is replaced in one
step after the last of them, and a run is registered there before its first. Batches of a run are
completed in order, so one number says it for all of them and the folder has one file a run for ever.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from amberline.functions.columns import text
from amberline.streaming.sinks import output_path

#: Before the first batch.
NONE = -1


def _files(spark: SparkSession, base: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(output_path(base, "commits"))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def commit(spark: SparkSession, base: str, run: str, batch_id: int) -> None:
    """Say that all batches of a run up to this one are complete."""
    files, folder = _files(spark, base)
    path = spark._jvm.org.apache.hadoop.fs.Path
    written = path(folder, f".{uuid.uuid4().hex}")
    stream = files.create(written, True)
    try:
        stream.write(bytearray(json.dumps({"run": run, "last_batch": batch_id}).encode()))
    finally:
        stream.close()
    gateway, rename = spark.sparkContext._gateway, getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(written, path(folder, f"{run}.json"), options)


def committed(spark: SparkSession, base: str) -> dict[str, int]:
    """The last complete batch of each registered run."""
    files, folder = _files(spark, base)
    found: dict[str, int] = {}
    if files.exists(folder):
        for status in files.listStatus(folder):
            if not status.getPath().getName().startswith("."):
                stream = files.open(status.getPath())
                try:
                    row = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                finally:
                    stream.close()
                found[row["run"]] = row["last_batch"]
    return found


def begin(spark: SparkSession, base: str, run: str, batch_id: int) -> bool:
    """Whether a batch is still to be written. A run is registered before its first output is."""
    last = committed(spark, base).get(run)
    if last is None:
        commit(spark, base, run, NONE if batch_id == 0 else batch_id - 1)
        return True
    return batch_id > last


def complete(last: dict[str, int]) -> str:
    """A condition on the folder columns: batches that are complete. Runs without a file are older than these."""
    unfinished = [f"(run = {text(run)} AND batch_id > {batch})" for run, batch in sorted(last.items())]
    return f"NOT ({' OR '.join(unfinished)})" if unfinished else "true"
