"""What the operators share: tables, saved steps, shared files and batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from amberline.session import scratch_path

WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Makes a query delete its shuffle files when it ends; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(frame: DataFrame, path: str) -> None:
    """Write a step to a path; its shuffles are deleted with its end, as the files hold all that comes from them."""
    spark = frame.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: later steps survive lost executors, and nothing is computed twice."""
    path = scratch_path(frame.sparkSession, label)
    write(frame, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it; works on workers and the driver alike."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to ``most`` or to one row."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > most:
            yield start, i
            start, total = i, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


def texts(column: pa.Array) -> list[str]:
    """The texts of a column, null as empty."""
    return [value or "" for value in column.to_pylist()]
