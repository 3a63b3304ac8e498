"""Row shapes of the outputs and the short lists shown to people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import aliased, status_label, with_sql
from amberline.schemas import ALERTS, CONSOLE_COLUMNS, RESULTS, names


def console_view(scored: DataFrame) -> DataFrame:
    return scored.select(*CONSOLE_COLUMNS)


def results_view(scored: DataFrame) -> DataFrame:
    return scored.withColumnRenamed("kafka_timestamp", "processed_time").select(*names(RESULTS))


def alerts_view(scored: DataFrame) -> DataFrame:
    """Only the rows predicted as fraud."""
    flagged = scored.where(F.col("is_fraud_predicted") == 1)
    return flagged.withColumnRenamed("kafka_timestamp", "alert_time").select(*names(ALERTS))


def legitimate(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("is_fraud_predicted") == 0)


def coerce_results(raw: DataFrame) -> DataFrame:
    """Make text ``amount``, ``fraud_probability`` and ``processed_time`` typed; bad text is null."""
    return with_sql(
        raw,
        {
            "amount": "try_cast(amount AS DOUBLE)",
            "fraud_probability": "try_cast(fraud_probability AS DOUBLE)",
            "processed_time": "try_to_timestamp(processed_time)",
        },
    )


def alert_card(alerts: DataFrame) -> DataFrame:
    """Alert fields for display: missing text is ``N/A``, missing numbers 0, money to 2 places."""
    texts = ("transaction_id", "user_id", "location", "merchant")
    numbers = ("amount", "fraud_probability")
    shown = {name: f"coalesce(CAST({name} AS STRING), 'N/A')" for name in texts}
    shown |= {name: f"round(coalesce({name}, 0D), 2)" for name in numbers}
    return alerts.selectExpr(*aliased(shown))


def recent_alerts(alerts: DataFrame, k: int = 5, with_total: bool = False) -> DataFrame:
    """The ``k`` newest alerts, ties by id; ``with_total`` adds how many there are in all.

    Top-k per partition and a merge of k rows each; the total is a separate counting scan.
    """
    newest = alerts.orderBy(F.desc("alert_time"), F.asc("transaction_id")).limit(k)
    if not with_total:
        return newest
    return newest.withColumn("total_alerts", alerts.agg(F.count("*")).scalar())


def recent_transactions(results: DataFrame, k: int = 8) -> DataFrame:
    """The ``k`` newest rows as user, amount, place and status."""
    newest = results.orderBy(F.desc("processed_time"), F.asc("transaction_id")).limit(k)
    return newest.selectExpr(
        "user_id", "round(amount, 2) AS amount", "location", f"{status_label()} AS status"
    )
