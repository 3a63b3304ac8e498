"""Options for the Kafka source and sink, and the message readers.

The connector is a separate artifact (``spark-sql-kafka-0-10``); the option builders work
without it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from amberline.operators.decode import json_value
from amberline.schemas import MESSAGE, struct

# Fixed value: the default topic.
TOPIC = "transactions"
MAX_PER_TRIGGER = 5_000_000


def stream_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    max_per_trigger: int = MAX_PER_TRIGGER,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options for a stream; ``min_partitions`` splits few topic partitions into more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def replay_options(
    servers: str, topic: str = TOPIC, min_partitions: int | None = None
) -> dict[str, str]:
    """Source options to read a whole topic once, from its beginning to its present end."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def publish_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Sink options: every replica acknowledges, three retries, order kept per partition."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
    }


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A stream of messages.

    Without ``format`` the options are those of the Kafka source. With a file format (``json``,
    ``parquet``, ...) they need a ``path``; the files hold ``value`` and ``timestamp``.
    """
    given = dict(options)
    kind = given.pop("format", "kafka")
    reader = spark.readStream.format(kind)
    if kind != "kafka":
        reader = reader.schema(struct(MESSAGE))
    return reader.options(**given).load()


def read_batch(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages as a batch: a topic from its beginning, or files as in ``read_stream``."""
    given = dict(options)
    kind = given.pop("format", "kafka")
    reader = spark.read.format(kind)
    if kind != "kafka":
        reader = reader.schema(struct(MESSAGE))
    return reader.options(**given).load()


def publish(df: DataFrame, options: Mapping[str, str]) -> None:
    """Send each row as a JSON message."""
    df.select(json_value(df)).write.format("kafka").options(**options).save()
