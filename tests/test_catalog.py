"""Queries that build message logs, over an events table of several files."""

import pytest
from pyspark.sql import functions as F

from amberline.plans import catalog
from amberline.sources.tables import transactions


@pytest.fixture
def events(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).selectExpr(
        "id AS event_id", "TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, cast(id * 10 AS INT)) AS ts", "id % 50 AS user_id", "'view' AS event_type", "id * 0.5D AS value"
    )
    rows.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    made = []

    def scratch(spark, label):
        made.append(f"{tmp_path}/{label}-{len(made)}")
        return made[-1]

    monkeypatch.setattr(catalog, "scratch_path", scratch)
    return str(tmp_path), made


def _files(spark, base):
    return spark.read.parquet(f"{base}/messages").groupBy(F.col("_metadata.file_path").alias("file")).count().collect()


def test_delayed_messages_are_written_by_many_tasks(spark, events):
    path, made = events
    got = catalog.stream_running_rate_shuffled(spark, path).orderBy("transactions", "is_final").collect()
    assert got == catalog.running_fraud_rate(transactions(spark, path)).select("transactions", "frauds", "fraud_rate", "is_final").orderBy("transactions", "is_final").collect()
    assert max(row["count"] for row in _files(spark, made[0])) < 600  # a quarter of the log and more, were a part one file


def test_messages_files_are_bounded(spark, events, monkeypatch):
    path, made = events
    monkeypatch.setattr(catalog, "FILE_MESSAGES", 300)
    assert catalog.stream_intake(spark, path).collect()[0].asDict() == {"messages": 4000, "refused": 3000, "scored": 1000}
    files = _files(spark, made[0])
    assert len(files) == 16 and max(row["count"] for row in files) <= 300
