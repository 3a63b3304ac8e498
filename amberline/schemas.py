"""Column layouts of every table that crosses a file or topic boundary.

A layout is a tuple of ``(name, type)`` pairs; all columns are nullable. Fixed values:
names, types and order are the contract with the producers and readers of these tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

Layout = tuple[tuple[str, str], ...]

TRANSACTION: Layout = (
    ("transaction_id", "string"),
    ("user_id", "int"),
    ("amount", "double"),
    ("timestamp", "string"),
    ("location", "string"),
    ("merchant", "string"),
    ("is_fraud", "int"),
)

# What the Kafka source yields.
ENVELOPE: Layout = (
    ("key", "binary"),
    ("value", "binary"),
    ("topic", "string"),
    ("partition", "int"),
    ("offset", "bigint"),
    ("timestamp", "timestamp"),
    ("timestampType", "int"),
)

# The part of the envelope the decoder needs; used by file streams of messages.
MESSAGE: Layout = (("value", "string"), ("timestamp", "timestamp"))

PARSED: Layout = (*TRANSACTION, ("kafka_timestamp", "timestamp"))

FEATURES: Layout = (
    ("hour", "int"),
    ("day_of_week", "int"),
    ("is_weekend", "int"),
    ("amount_log", "double"),
    ("is_high_amount", "int"),
    ("is_low_amount", "int"),
    ("location_risk", "int"),
    ("merchant_length", "int"),
    ("is_online_merchant", "int"),
)

VERDICT: Layout = (
    ("fraud_probability", "double"),
    ("is_fraud_predicted", "int"),
    ("prediction_method", "string"),
)

SCORED: Layout = (*PARSED, *FEATURES, *VERDICT)

# Results CSV. The arrival time of the message is published as ``processed_time``.
RESULTS: Layout = (
    ("transaction_id", "string"),
    ("user_id", "int"),
    ("amount", "double"),
    ("location", "string"),
    ("merchant", "string"),
    ("fraud_probability", "double"),
    ("is_fraud_predicted", "int"),
    ("is_fraud", "int"),
    ("prediction_method", "string"),
    ("processed_time", "timestamp"),
)

# Alerts JSON lines. The arrival time of the message is published as ``alert_time``.
ALERTS: Layout = (
    ("transaction_id", "string"),
    ("user_id", "int"),
    ("amount", "double"),
    ("location", "string"),
    ("merchant", "string"),
    ("fraud_probability", "double"),
    ("is_fraud", "int"),
    ("alert_time", "timestamp"),
)

CONSOLE_COLUMNS: tuple[str, ...] = (
    "transaction_id",
    "user_id",
    "amount",
    "location",
    "merchant",
    "fraud_probability",
    "is_fraud_predicted",
    "is_fraud",
)

# A quote inside a field is doubled, so any CSV reader gets it back; spaces are kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def names(layout: Layout) -> list[str]:
    return [name for name, _ in layout]


def ddl(layout: Layout) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in layout)


def struct(layout: Layout) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in layout])
