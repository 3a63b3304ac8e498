"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Event times are strings, so hours and weekdays depend on the session zone: pin it.
# Dedup state can outgrow the heap, so it goes to RocksDB, and its checkpoints hold changes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "amberline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; ``conf`` wins over them (``__`` stands for a dot)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    return builder.config(map={**SETTINGS, **overrides}).getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in a folder that all executors share: ``spark.checkpoint.dir``, or else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    files, place = _place(spark, path)
    files.delete(place, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; nothing where there is none."""
    files, place = _place(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
