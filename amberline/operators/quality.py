"""Data-quality checks on messages and rows, one aggregation pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import aliased, percent, text
from amberline.schemas import TRANSACTION, ddl, names

_FIELDS = names(TRANSACTION)
_NO_FIELD = " AND ".join(f"r.`{name}` IS NULL" for name in _FIELDS)

# Text the record parser rejects leaves no field at all, so only such rows are parsed again to
# tell broken JSON from values of the wrong type.
_REASON = f"""CASE
    WHEN body IS NULL OR trim(body) = '' THEN 'empty'
    WHEN r.bad IS NOT NULL AND {_NO_FIELD} AND try_parse_json(body) IS NULL THEN 'not_json'
    WHEN r.bad IS NOT NULL THEN 'wrong_type'
    WHEN {_NO_FIELD} THEN 'no_known_field' END"""
REASONS = ("empty", "not_json", "wrong_type", "no_known_field")


def _judged(messages: DataFrame) -> DataFrame:
    """(body, r, reason, kafka_timestamp): the record ``r``, and why a message cannot be taken."""
    schema = f"{ddl(TRANSACTION)}, `bad` string"
    record = f"from_json(body, '{schema}', map('columnNameOfCorruptRecord', 'bad')) AS r"
    return (
        messages.selectExpr("CAST(value AS STRING) AS body", "timestamp AS kafka_timestamp")
        .selectExpr("body", f"inline(array(struct({record})))", "kafka_timestamp")
        .selectExpr("body", "r", f"{_REASON} AS reason", "kafka_timestamp")
    )


def judge_transactions(messages: DataFrame) -> DataFrame:
    """As ``parse_transactions``, with ``_body`` (the message) and ``_reason`` (null, or why it cannot be taken), from one decode."""
    return _judged(messages).selectExpr("r.* EXCEPT (bad)", "kafka_timestamp", "body AS _body", "reason AS _reason")


def refused(judged: DataFrame) -> DataFrame:
    """The judged messages that cannot be taken, as ``quarantine`` gives them."""
    return judged.where("_reason IS NOT NULL").selectExpr("_body AS value", "_reason AS reason", "kafka_timestamp")


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages that are empty, not JSON, of a wrong type or without any known field, and why."""
    judged = _judged(messages).where("reason IS NOT NULL")
    return judged.selectExpr("body AS value", "reason", "kafka_timestamp")


def schema_violations(messages: DataFrame) -> DataFrame:
    """Messages per failed check: rows (check, violations, checked, violation_pct).

    The message checks exclude one another; the field checks run on messages that pass them.
    """
    sound = "reason IS NULL"
    checks = {name: f"reason = '{name}'" for name in REASONS}
    checks |= {f"missing_{name}": f"{sound} AND r.`{name}` IS NULL" for name in _FIELDS}
    checks["bad_timestamp"] = (
        f"{sound} AND r.timestamp IS NOT NULL AND try_to_timestamp(r.timestamp) IS NULL"
    )
    checks["negative_amount"] = f"{sound} AND r.amount < 0"
    checks["bad_label"] = f"{sound} AND r.is_fraud NOT IN (0, 1)"
    counts = {name: f"count_if({condition})" for name, condition in checks.items()}
    counted = _judged(messages).selectExpr("count(*) AS n_rows", *aliased(counts))
    rows = _as_rows(counted, list(checks))
    return rows.selectExpr(
        "name AS check", "n AS violations", "n_rows AS checked", f"{percent('n', 'n_rows')} AS violation_pct"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column: rows (column_name, null_count, row_count, null_pct)."""
    counts = {name: f"count_if(`{name}` IS NULL)" for name in df.columns}
    rows = _as_rows(df.selectExpr("count(*) AS n_rows", *aliased(counts)), df.columns)
    return rows.selectExpr(
        "name AS column_name", "n AS null_count", "n_rows AS row_count", f"{percent('n', 'n_rows')} AS null_pct"
    )


def _as_rows(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One wide row of counts as one row (n_rows, name, n) per count."""
    entries = ", ".join(f"struct({text(name)} AS name, `{name}` AS n)" for name in columns)
    return counted.selectExpr("n_rows", f"inline(array({entries}))")


def freshness(df: DataFrame, as_of: str, by: str | None = None) -> DataFrame:
    """Whole seconds from the newest arrival to ``as_of``, per ``by`` if given."""
    newest = df.groupBy(*([by] if by else [])).agg(F.max("kafka_timestamp").alias("newest"))
    age = f"timestampdiff(SECOND, newest, CAST({text(as_of)} AS TIMESTAMP))"
    return newest.selectExpr("*", f"{age} AS age_seconds")


#: As ``within``: repeats are recognised however much later they come.
ALWAYS = "always"


def deduplicate(df: DataFrame, within: str = "10 minutes") -> DataFrame:
    """One row per ``transaction_id``, the earliest to arrive; rows without an id are all kept.

    The source is read once: rows without an id get a key of their own, which nothing repeats.
    On a stream the repeats of an id are recognised within ``within`` of arrival time; copies of
    one id meet in one task, at most as many as a trigger takes in, and each row without an id
    takes one entry of state until ``within`` has passed. With ``ALWAYS`` every id ever seen stays in the
    state, which RocksDB keeps on disk and looks up by Bloom filters, so a batch costs what it holds and
    not what came before; checkpoints hold changes only. In batch each task keeps one copy per
    id before the shuffle, so an id repeated many times stays cheap.
    """
    alone = "uuid()" if df.isStreaming else "CAST(monotonically_increasing_id() AS STRING)"
    keyed = df.selectExpr("*", f"CASE WHEN transaction_id IS NULL THEN {alone} END AS _alone")
    key = ["transaction_id", "_alone"]
    if df.isStreaming and within == ALWAYS:
        return keyed.dropDuplicates(key).drop("_alone")
    if df.isStreaming:
        unique = keyed.withWatermark("kafka_timestamp", within).dropDuplicatesWithinWatermark(key)
        return unique.drop("_alone")
    rest = [name for name in df.columns if name not in ("transaction_id", "kafka_timestamp")]
    earliest = F.min(F.struct("kafka_timestamp", *rest)).alias("r")
    return keyed.groupBy(*key).agg(earliest).select("transaction_id", "r.*")
