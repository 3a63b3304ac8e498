"""SQL fragments and column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def with_sql(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add (or replace) columns given as SQL expressions, in one projection."""
    kept = [f"`{name}`" for name in df.columns if name not in columns]
    return df.selectExpr(*kept, *aliased(columns))


def aliased(columns: Mapping[str, str]) -> list[str]:
    return [f"{sql} AS `{name}`" for name, sql in columns.items()]


def flag(condition: str) -> str:
    """1 where the condition holds, 0 where it is false or unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ratio(part: str, whole: str) -> str:
    """part / whole, null when the whole is 0."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


def percent(part: str, whole: str, digits: int = 1) -> str:
    return f"round(try_divide(CAST({part} * 100 AS DOUBLE), CAST({whole} AS DOUBLE)), {digits})"


def status_label(predicted: str = "is_fraud_predicted") -> str:
    return f"CASE WHEN {predicted} = 1 THEN 'FRAUD' ELSE 'LEGIT' END"


def amount_sum(amount: str = "amount", within: str = "true") -> str:
    """Sum of the amounts in ``within``; null and NaN are left out, 0 when there are none."""
    return f"coalesce(sum(nanvl({amount}, CAST(NULL AS DOUBLE))) FILTER (WHERE {within}), 0D)"


def amount_count(amount: str = "amount", within: str = "true") -> str:
    return f"count_if(nanvl({amount}, CAST(NULL AS DOUBLE)) IS NOT NULL AND {within})"


def money(value: str, digits: int = 2) -> str:
    """An amount as it is reported. Only here is it rounded."""
    return f"round({value}, {digits})"
