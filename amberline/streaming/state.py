"""Report figures from partial aggregates that are kept with each micro-batch.

A batch's state is a few sums per class, label and amount bucket, and the flagged rows per location. States
add up, so a report merges those of all batches and reads no scored row. Compaction merges states of old
batches into one, so their number stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.functions.columns import aliased, amount_count, amount_sum
from amberline.operators import report
from amberline.session import exists
from amberline.streaming import commits
from amberline.streaming.monitor import wait_sketches, waits_over_time
from amberline.streaming.sinks import output_path

KEYS = ["kind", "location", "is_fraud_predicted", "is_fraud", "bucket_no", "window_start"]
SUMS = ["n", "amount_total", "n_amounts"]
SKETCHES = ["worst", "sketch"]
STATE = (
    "kind string, location string, is_fraud_predicted int, is_fraud int, bucket_no int, n long, amount_total double, n_amounts long, "
    "window_start timestamp, worst long, sketch binary"
)
ROWS, PLACES = "rows", "places"
#: How many messages a batch had, and how many of them it refused.
MESSAGES, REFUSED = "messages", "refused"
#: Waiting times per minute of writing, as sketches.
WAITED = "waited"


def batch_state(rows: DataFrame) -> DataFrame:
    """The state of scored (or result) rows: each of its two parts is one partial aggregate before a small shuffle."""
    sums = {"n": "count(*)", "amount_total": amount_sum(), "n_amounts": amount_count()}
    placed = rows.select("is_fraud_predicted", "is_fraud", "amount", report.bucket_no().alias("bucket_no"))
    figures = placed.groupBy("is_fraud_predicted", "is_fraud", "bucket_no").agg(*(F.expr(sql) for sql in aliased(sums)))
    flagged = rows.where("is_fraud_predicted = 1 AND location IS NOT NULL").groupBy("location").agg(F.count("*").alias("n"))
    return _shaped(figures, ROWS).unionByName(_shaped(flagged, PLACES))


def _shaped(part: DataFrame, kind: str) -> DataFrame:
    given = {"kind": f"'{kind}'", **{name: f"`{name}`" for name in part.columns}}
    fields = (field.split() for field in STATE.split(", "))
    return part.selectExpr(*(f"CAST({given.get(name, 'NULL')} AS {kind_}) AS `{name}`" for name, kind_ in fields))


def counted(spark: SparkSession, messages: int, refused: int) -> DataFrame:
    """A batch's messages and refused messages as rows of state."""
    rows = [(kind, None, None, None, None, n, None, None, None, None, None) for kind, n in ((MESSAGES, messages), (REFUSED, refused))]
    return spark.createDataFrame(rows, STATE)


def waited(files: DataFrame) -> DataFrame:
    """State of rows as read from their files: how long they waited from arrival to the write of their file."""
    return _shaped(wait_sketches(files.selectExpr("kafka_timestamp AS arrival", "_metadata.file_modification_time AS written")), WAITED)


def merged(states: DataFrame) -> DataFrame:
    """Many states as one."""
    sums = (F.sum(name).alias(name) for name in SUMS)
    figures = states.where(f"kind <> '{WAITED}'").groupBy(*KEYS).agg(*sums)
    sketched = states.where(f"kind = '{WAITED}'").groupBy("window_start").agg(
        F.sum("n").alias("n"), F.max("worst").alias("worst"), F.expr("kll_merge_agg_bigint(sketch)").alias("sketch")
    )
    without = {"worst": F.lit(None).cast("long"), "sketch": F.lit(None).cast("binary")}
    return figures.withColumns(without).unionByName(_shaped(sketched, WAITED))


def read_state(spark: SparkSession, base: str, last: dict[str, int] | None = None, done: list | None = None) -> DataFrame | None:
    """The merged state of all complete batches, merged ones included; None where no state is kept.

    ``last`` and ``done`` are those of a snapshot, else what is there now.
    """
    from amberline.streaming.compaction import after, done_rows, reached

    path = output_path(base, "state")
    if not exists(spark, path):
        return None
    done = done_rows(spark, base, "state") if done is None else done
    last = commits.committed(spark, base) if last is None else last
    states = spark.read.schema(f"{STATE}, run string, batch_id int").parquet(path)
    rows = states.where(after(reached(done))).where(commits.complete(last)).select(*KEYS, *SUMS, *SKETCHES)
    if done:
        chunks = spark.read.schema(f"{STATE}, chunk string").parquet(f"{path}_daily")
        rows = chunks.where(F.col("chunk").isin(sorted({row.chunk for row in done}))).select(*KEYS, *SUMS, *SKETCHES).unionByName(rows)
    return merged(rows)


_FLAGGED, _LABELLED = "is_fraud_predicted = 1", "is_fraud = 1"


def _summed(name: str, within: str = "true") -> str:
    return f"coalesce(sum({name}) FILTER (WHERE {within}), CAST(0 AS {'DOUBLE' if name == 'amount_total' else 'LONG'}))"


def summary(state: DataFrame) -> DataFrame:
    """As ``report.summary`` of all rows."""
    sums = {
        "total_transactions": _summed("n"),
        "fraud_detected": _summed("n", _FLAGGED),
        "actual_fraud": _summed("n", _LABELLED),
        "true_positives": _summed("n", f"{_FLAGGED} AND {_LABELLED}"),
        "total": _summed("amount_total"),
        "flagged": _summed("amount_total", _FLAGGED),
        "n_amounts": _summed("n_amounts"),
        "n_flagged_amounts": _summed("n_amounts", _FLAGGED),
    }
    return report.summary_of(state.where(f"kind = '{ROWS}'").selectExpr(*aliased(sums)))


def class_split(state: DataFrame) -> DataFrame:
    """As ``report.class_split`` of all rows."""
    rows = state.where(f"kind = '{ROWS}'")
    counts = {name: _summed("n", f"is_fraud_predicted = {value}") for value, name in report.CLASS_LABELS.items()}
    return report.class_split_of(rows.selectExpr(*aliased(counts)))


def amount_buckets(state: DataFrame) -> DataFrame:
    """As ``report.amount_buckets`` of all rows."""
    rows = state.where(f"kind = '{ROWS}'").groupBy("bucket_no")
    return report.amount_buckets_of(
        rows.agg(F.expr(f"{_summed('n', 'is_fraud_predicted = 0')} AS legitimate"), F.expr(f"{_summed('n', _FLAGGED)} AS fraudulent"))
    )


def top_locations(state: DataFrame, k: int = 10) -> DataFrame:
    """As ``report.top_locations`` of all rows."""
    rows = state.where(f"kind = '{PLACES}'").groupBy("location").agg(F.sum("n").alias("fraud_count"))
    return rows.orderBy(F.desc("fraud_count"), "location").limit(k)


def intake(state: DataFrame) -> DataFrame:
    """One row: messages that batches were given, and how many of them were refused; only batches that count them."""
    counts = {name: _summed("n", f"kind = '{name}'") for name in (MESSAGES, REFUSED)}
    return state.selectExpr(*aliased(counts))


def waits(state: DataFrame, width: str = "1 minute") -> DataFrame:
    """Waiting times per window of writing, from the sketches that batches keep."""
    return waits_over_time(state.where(f"kind = '{WAITED}'").select("window_start", "n", "worst", "sketch"), width)
