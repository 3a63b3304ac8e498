"""The given ``events`` table seen as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from amberline.functions.columns import aliased

_FROM_EVENTS = {
    "transaction_id": "CAST(event_id AS STRING)",
    "user_id": "CAST(user_id + 1000 AS INT)",
    "amount": "value * 40D",
    "timestamp": "concat(substr(CAST(ts AS STRING), 1, 10), 'T', substr(CAST(ts AS STRING), 12, 8))",
    "location": """CASE user_id % 12 WHEN 0 THEN 'Lagos' WHEN 1 THEN 'Mumbai' WHEN 2 THEN 'Austin'
                                     WHEN 3 THEN 'Boston' ELSE 'Denver' END""",
    "merchant": """CASE event_type WHEN 'view' THEN 'Online Books' WHEN 'click' THEN 'Acme Ltd'
                                   ELSE concat('Shop ', event_type) END""",
    "is_fraud": "CAST(event_id % 33 = 0 AS INT)",
    "kafka_timestamp": "CAST(ts AS TIMESTAMP)",
}


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map events to the transaction columns plus ``kafka_timestamp`` (see FIXTURES.md section 6)."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*aliased(_FROM_EVENTS))
