"""Messages to transactions and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amberline.schemas import TRANSACTION, ddl, names


def parse_transactions(messages: DataFrame, guard: bool = True) -> DataFrame:
    """Decode the JSON ``value`` of each message into the transaction columns.

    One row in, one row out: a message that is not a JSON object becomes a row of nulls, a
    field of the wrong type becomes null on its own, unknown keys are ignored. The broker's
    ``timestamp`` is kept as ``kafka_timestamp``, apart from the event's own ``timestamp``.

    A filter on parsed or derived columns would be pushed below a plain projection and parse
    the text again for every field it reads. ``guard`` prevents that: the record is produced
    by a generator, which filters do not pass. It costs about a tenth of the parse, so plans
    without such a filter may turn it off.
    """
    record = F.from_json(F.col("value").cast("string"), ddl(TRANSACTION))
    arrival = F.col("timestamp").alias("kafka_timestamp")
    if guard:
        return messages.select(F.inline(F.array(record)), arrival)
    return messages.select(record.alias("record"), arrival).select("record.*", "kafka_timestamp")


def json_value(df: DataFrame) -> Column:
    """The row's transaction columns as one UTF-8 JSON value; null fields are left out."""
    present = [name for name in names(TRANSACTION) if name in df.columns]
    return F.to_json(F.struct(*present)).cast("binary").alias("value")


def to_messages(df: DataFrame) -> DataFrame:
    """Transactions as messages: ``value``, plus the arrival time when the frame has one."""
    columns = [json_value(df)]
    if "kafka_timestamp" in df.columns:
        columns.append(F.col("kafka_timestamp").alias("timestamp"))
    return df.select(*columns)
