"""Figures about the running job: throughput, flag rate, latency, source lag."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from amberline.functions.columns import aliased, percent
from amberline.schemas import SCORED, ddl
from amberline.session import listed


def _per_window(df: DataFrame, width: str, late: str, measures: dict[str, str]) -> DataFrame:
    # Event times are arbitrary, so windows and watermark go by arrival time.
    source = df.withWatermark("kafka_timestamp", late) if df.isStreaming else df
    grouped = source.groupBy(F.window("kafka_timestamp", width).alias("w"))
    counted = grouped.agg(*(F.expr(column) for column in aliased(measures)))
    return counted.selectExpr("w.start AS window_start", "w.end AS window_end", *measures)


def throughput(df: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Transactions per arrival window."""
    return _per_window(df, width, late, {"transactions": "count(*)"})


def flag_rate_over_time(
    scored: DataFrame, width: str = "1 minute", late: str = "10 minutes"
) -> DataFrame:
    """Transactions, flagged ones and their share per arrival window."""
    measures = {"transactions": "count(*)", "flagged": "count_if(is_fraud_predicted = 1)"}
    counted = _per_window(scored, width, late, measures)
    return counted.selectExpr("*", f"{percent('flagged', 'transactions')} AS flag_rate")


def waiting_times(rows: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Seconds from ``arrival`` to ``written``: median, 95th, 99th, largest. Percentiles are mergeable sketches."""
    waited = rows.selectExpr("unix_micros(written) - unix_micros(arrival) AS us")
    return waited.selectExpr(
        "count(us) AS transactions",
        f"percentile_approx(us, array(0.5, 0.95, 0.99), {accuracy}) AS p",
        "max(us) AS worst",
    ).selectExpr(
        "transactions", "p[0] / 1e6D AS p50", "p[1] / 1e6D AS p95", "p[2] / 1e6D AS p99", "worst / 1e6D AS max"
    )


#: Size of a waiting-time sketch: ranks are right within 1.1 % with 99 % certainty, and exactly for as many values or fewer.
SKETCH = 400
WAITS = "window_start timestamp, n long, worst long, sketch binary"


def wait_sketches(rows: DataFrame, width: str = "1 minute", at: str = "written") -> DataFrame:
    """Waiting times from ``arrival`` to ``written`` per window of ``at``, as rows of ``WAITS`` to keep and to merge.

    A window takes a few kilobytes however many rows it has, and is sketched before the shuffle. Rows
    without one of the times are left out.
    """
    waited = rows.selectExpr(f"window({at}, '{width}').start AS window_start", "unix_micros(written) - unix_micros(arrival) AS us").where("us IS NOT NULL")
    return waited.groupBy("window_start").agg(
        F.count("us").alias("n"), F.max("us").alias("worst"), F.expr(f"kll_sketch_agg_bigint(us, {SKETCH})").alias("sketch")
    )


def waits_over_time(sketches: DataFrame, width: str = "1 minute") -> DataFrame:
    """Kept sketches merged into windows of ``width`` (not below the one they have): seconds as in ``waiting_times``."""
    placed = sketches.selectExpr(f"window(window_start, '{width}').start AS window_start", "n", "worst", "sketch")
    merged = placed.groupBy("window_start").agg(
        F.sum("n").alias("transactions"), F.max("worst").alias("worst"), F.expr("kll_merge_agg_bigint(sketch)").alias("sketch")
    )
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return merged.selectExpr(
        "window_start",
        "transactions",
        *(f"kll_sketch_get_quantile_bigint(sketch, {share}D) / 1e6D AS {name}" for name, share in shares.items()),
        "worst / 1e6D AS max",
    )


def latency(spark: SparkSession, predictions_path: str) -> DataFrame:
    """Seconds from arrival to the write of the file a row is in; reads two columns only."""
    files = spark.read.schema(ddl(SCORED)).parquet(predictions_path)
    return waiting_times(files.selectExpr("kafka_timestamp AS arrival", "_metadata.file_modification_time AS written"))


def source_lag(progress: dict[str, Any]) -> list[dict[str, Any]]:
    """One record per source of a progress report that says how far it is behind its topic."""
    records = []
    for source in progress.get("sources", []):
        metrics = source.get("metrics") or {}
        behind = {
            f"{kind}_behind": int(float(metrics[f"{kind}OffsetsBehindLatest"]))
            for kind in ("min", "avg", "max")
            if f"{kind}OffsetsBehindLatest" in metrics
        }
        if behind:
            records.append(
                {
                    "query": progress.get("name") or progress.get("id"),
                    "batch_id": progress.get("batchId"),
                    "at": progress.get("timestamp"),
                    "source": source.get("description"),
                    **behind,
                }
            )
    return records


def offset_gap(reached: Any, latest: Any) -> int | None:
    """How far ``latest`` is ahead of ``reached``: the sum over all numbers in them, whatever their nesting.

    A part that ``reached`` lacks counts from 0. None where the two do not fit.
    """
    if isinstance(latest, dict) and isinstance(reached or {}, dict):
        gaps = [offset_gap((reached or {}).get(name), value) for name, value in latest.items()]
        return None if None in gaps else sum(gaps)
    numbers = isinstance(latest, (int, float)) and isinstance(reached or 0, (int, float))
    return max(int(latest) - int(reached or 0), 0) if numbers else None


def offset_lag(progress: dict[str, Any]) -> list[dict[str, Any]]:
    """One record per source that reports its latest offset: how many offsets the batch began, ended and stays behind.

    For sources without a latest offset (message files) there is ``file_backlog``.
    """
    records = []
    for source in progress.get("sources", []):
        start, end, latest = (_offset(source.get(name)) for name in ("startOffset", "endOffset", "latestOffset"))
        behind = offset_gap(end, latest)
        if behind is not None:
            records.append(
                {
                    "query": progress.get("name") or progress.get("id"),
                    "batch_id": progress.get("batchId"),
                    "at": progress.get("timestamp"),
                    "source": source.get("description"),
                    "taken": offset_gap(start, end),
                    "behind": behind,
                }
            )
    return records


def _offset(given: Any) -> Any:
    """Offsets come as JSON, or as text that holds JSON."""
    if isinstance(given, str):
        try:
            return json.loads(given)
        except ValueError:
            return None
    return given


def file_backlog(spark: SparkSession, path: str, checkpoint: str, source: int = 0) -> DataFrame:
    """Message files that no committed batch has taken: one row (files, bytes, oldest), ``oldest`` null when there are none.

    From the checkpoint alone, so it can be asked while the query runs, or when it is down. What a batch has
    planned but not committed still waits. Files are listed by Spark and joined by path; none is opened.
    """
    given = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    waiting = given.select("path", "length", "modificationTime")
    committed = [int(name) for name in listed(spark, f"{checkpoint}/commits") if name.isdigit()]
    if committed:
        # Line 1 is a version, line 2 the batch's settings, then the offset of each source.
        offsets = spark.read.text(f"{checkpoint}/offsets/{max(committed)}", wholetext=True).first().value.splitlines()
        reached = json.loads(offsets[2 + source])["logOffset"]
        log = spark.read.text(f"{checkpoint}/sources/{source}").selectExpr("from_json(value, 'path string, batchId long') AS e")
        taken = log.where(f"e.batchId <= {int(reached)}").selectExpr(f"{_PLAIN.format('e.path')} AS taken").distinct()
        waiting = waiting.join(taken, F.expr(f"{_PLAIN.format('path')} = taken"), "left_anti")
    return waiting.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.min("modificationTime").alias("oldest"))


# Paths are written with one slash or three after the scheme, and with escapes or without.
_PLAIN = "url_decode(replace(regexp_replace({}, '^file:/+', '/'), '+', '%2B'))"


class LagListener(StreamingQueryListener):
    """Appends the lag in progress reports to a folder of JSON lines, ``every`` records at a time and at the end.

    Records wait on the driver; a write is a small Spark job on the listener's thread, so it is kept rare.
    """

    COLUMNS = (
        "query string, batch_id bigint, at string, source string, "
        "min_behind bigint, avg_behind bigint, max_behind bigint, taken bigint, behind bigint"
    )

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self._spark, self._path, self._every = spark, path, every
        self._waiting: list[dict[str, Any]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def record(self, progress: dict[str, Any]) -> None:
        by_source = {record["source"]: record for record in offset_lag(progress)}
        for record in source_lag(progress):
            by_source[record["source"]] = {**by_source.get(record["source"], {}), **record}
        self._waiting += by_source.values()
        if len(self._waiting) >= self._every:
            self.flush()

    def flush(self) -> None:
        records, self._waiting = self._waiting, []
        if records:
            rows = self._spark.createDataFrame(records, self.COLUMNS)
            rows.coalesce(1).write.mode("append").json(self._path)
