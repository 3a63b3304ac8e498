"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amberline.functions.columns import aliased, status_label
from amberline.functions.rules import DEFAULT_RULES
from amberline.operators import evaluation, quality, report, views
from amberline.operators.decode import parse_transactions, to_messages
from amberline.operators.features import (
    AMOUNT_FEATURES,
    MERCHANT_FEATURES,
    TIME_FEATURES,
    engineer_features,
    location_features,
)
from amberline.operators.running import running_fraud_rate
from amberline.operators.scoring import score, score_ensemble, score_model, score_rules
from amberline.operators.unions import union_all
from amberline.schemas import CSV_OPTIONS, SCORED, names
from amberline.session import scratch_path
from amberline.sources.files import read_alerts, read_predictions, read_results
from amberline.sources.kafka import read_batch
from amberline.sources.models import load_model
from amberline.sources.tables import transactions
from amberline.streaming import monitor, state
from amberline.streaming.compaction import compact, compact_state, read_compacted, take_snapshot
from amberline.streaming.run import JobConfig, run_job
from amberline.streaming.sinks import FILE_SINKS, output_path
from amberline.streaming.totals import start_running_rate, waiting_rate

Query = Callable[[SparkSession, str], DataFrame]
#: Messages in one file of a log that is dealt into batches.
FILE_MESSAGES = 250_000


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(engineer_features(transactions(spark, sf_dir)))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.results_view(_scored(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.alerts_view(_scored(spark, sf_dir))


def _on_scored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_scored(spark, sf_dir))


# --- decode and features -------------------------------------------------------------------


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_transactions(to_messages(transactions(spark, sf_dir)))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = to_messages(transactions(spark, sf_dir))
    return sent.select(F.col("value").cast("string").alias("value"), "timestamp")


def tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of all transactions, six of every eight spoilt in a way of their own."""
    rows = transactions(spark, sf_dir)
    plain = F.to_json(F.struct(*[c for c in rows.columns if c != "kafka_timestamp"]))
    kind = F.col("transaction_id").cast("bigint") % 8
    spoilt = (
        F.when(kind == 0, F.concat(F.lit("not json "), F.col("merchant")))
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.regexp_replace(plain, '"user_id":([0-9]+)', '"user_id":"$1"'))
        .when(kind == 3, F.expr("substr(body, 1, length(body) - 1)"))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.regexp_replace(plain, '"is_fraud":[01]', '"is_fraud":true'))
        .when(kind == 6, F.regexp_replace(plain, '"user_id"', '"USER_ID"'))
        .otherwise(plain)
    )
    return rows.withColumn("body", plain).select(
        spoilt.alias("value"), F.col("kafka_timestamp").alias("timestamp")
    )


def parse_tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_transactions(tampered(spark, sf_dir))


def features_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).selectExpr("transaction_id", *aliased(TIME_FEATURES))


def features_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).selectExpr("transaction_id", *aliased(AMOUNT_FEATURES))
    return rows.withColumn("amount_log", F.round("amount_log", 8))


def features_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = {**location_features(), **MERCHANT_FEATURES}
    return transactions(spark, sf_dir).selectExpr("transaction_id", *aliased(added))


def features_risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location risk from a table: here the places whose flagged share is above one half."""
    rows = _scored(spark, sf_dir)
    shares = rows.groupBy("location").agg(F.avg("is_fraud_predicted").alias("share"))
    joined = engineer_features(transactions(spark, sf_dir), shares.where("share > 0.5"))
    return joined.select("transaction_id", "location", "location_risk")


# --- rules and scores ----------------------------------------------------------------------


def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each rule holds for."""
    rows = engineer_features(transactions(spark, sf_dir))
    counted = rows.selectExpr(*(f"count_if({rule.predicate}) AS {rule.name}" for rule in DEFAULT_RULES))
    pairs = ", ".join(f"struct('{r.name}' AS rule, {r.name} AS hits)" for r in DEFAULT_RULES)
    return counted.selectExpr(f"inline(array({pairs}))")


def rules_fired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_rules(engineer_features(transactions(spark, sf_dir)), explain=True)
    return rows.select("transaction_id", F.array_join("rules_fired", "+").alias("rules_fired"))


def score_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(
        "transaction_id", "fraud_probability", "is_fraud_predicted", "prediction_method"
    )


def predictions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 20 columns, by way of the message encoding."""
    rows = score(engineer_features(parsed(spark, sf_dir)))
    return rows.select(*names(SCORED)).withColumn("amount_log", F.round("amount_log", 8))


# The features of two values.
FLAGS = ("is_weekend", "is_high_amount", "is_low_amount", "location_risk", "is_online_merchant")


def _features_with_model(spark: SparkSession, sf_dir: str):
    """Feature rows, and a model fitted on all of them in closed form, saved and loaded again."""
    rows = engineer_features(transactions(spark, sf_dir))
    path = scratch_path(spark, "model")
    bayes = NaiveBayes(modelType="bernoulli", smoothing=1.0, featuresCol="features", labelCol="is_fraud")
    Pipeline(stages=[VectorAssembler(inputCols=list(FLAGS), outputCol="features"), bayes]).fit(rows).save(path)
    return rows, load_model(path)


def _verdicts(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_id",
        F.round("fraud_probability", 6).alias("fraud_probability"),
        "is_fraud_predicted",
        "prediction_method",
    )


def score_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _features_with_model(spark, sf_dir)
    return _verdicts(score_model(rows, model))


def score_ensemble_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _features_with_model(spark, sf_dir)
    return _verdicts(score_ensemble(rows, model, weight=0.7))


def amount_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amount as a score: how well each threshold of it tells frauds, on the ids outside the holdout."""
    rows = transactions(spark, sf_dir).where(f"NOT {evaluation.in_holdout()}")
    return evaluation.precision_recall(rows, "amount")


def model_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _features_with_model(spark, sf_dir)
    scored = score_model(rows, model).select(F.round("fraud_probability", 6).alias("p"), "is_fraud")
    return evaluation.precision_recall(scored, "p")


def amount_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best_threshold(evaluation.precision_recall(transactions(spark, sf_dir), "amount"))


# --- reports -------------------------------------------------------------------------------


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to top flagged locations."""
    return report.top_locations(score(engineer_features(parsed(spark, sf_dir))))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _scored(spark, sf_dir).selectExpr(f"{status_label()} AS status")
    return labelled.groupBy("status").agg(F.count("*").alias("transactions"))


def alert_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display fields of alerts in which every third amount and every fifth place is absent."""
    number = F.col("transaction_id").cast("bigint")
    holed = _alerts(spark, sf_dir).withColumns(
        {
            "amount": F.when(number % 3 != 0, F.col("amount")),
            "location": F.when(number % 5 != 0, F.col("location")),
        }
    )
    return views.alert_card(holed)


def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows as text with one amount, score or time in each nine made unreadable."""
    kind = F.col("transaction_id").cast("bigint") % 9
    text = _results(spark, sf_dir).select(
        "transaction_id",
        F.when(kind == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(kind == 1, "high").otherwise(F.col("fraud_probability").cast("string")).alias(
            "fraud_probability"
        ),
        F.when(kind == 2, "yesterday-ish")
        .otherwise(F.col("processed_time").cast("string"))
        .alias("processed_time"),
    )
    return views.coerce_results(text)


def running_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_fraud_rate(transactions(spark, sf_dir))


# --- files ---------------------------------------------------------------------------------


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "results")
    _results(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path)
    return read_results(spark, path)


def results_other_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results in files of four layouts: as written now, without a method, in another order, with odd columns more."""
    path = scratch_path(spark, "results")
    rows = _results(spark, sf_dir)
    extra = {"batch no": F.lit(7), "risk-score": F.lit(0.5), "1st_amount": F.col("amount")}
    kinds = [rows, rows.drop("prediction_method"), rows.select(*reversed(rows.columns)), rows.withColumns(extra)]
    for kind, shaped in enumerate(kinds):
        part = shaped.where(F.pmod(F.col("transaction_id").cast("bigint"), F.lit(4)) == kind)
        part.write.options(**CSV_OPTIONS).csv(f"{path}/kind={kind}")
    return read_results(spark, path)


def alerts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "alerts")
    _alerts(spark, sf_dir).write.json(path)
    return read_alerts(spark, path)


def union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written by two versions of the job, the older one without a method column."""
    rows = _results(spark, sf_dir)
    older = rows.where("is_fraud = 1").drop("prediction_method")
    return union_all([rows.where("is_fraud = 0"), older])


def messages_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message log read from its beginning as a batch, decoded."""
    path = scratch_path(spark, "messages")
    messages(spark, sf_dir).write.parquet(path)
    return parse_transactions(read_batch(spark, {"format": "parquet", "path": path}))


# --- streams -------------------------------------------------------------------------------


def _run_stream(spark: SparkSession, sf_dir: str, **settings) -> str:
    """Score a message log as a stream, up to its end; returns the output folder."""
    base = scratch_path(spark, "stream")
    messages(spark, sf_dir).write.parquet(f"{base}/messages")
    source = {"format": "parquet", "path": f"{base}/messages", "maxFilesPerTrigger": "100"}
    run_job(spark, JobConfig(base, source, available_now=True, **{"sinks": FILE_SINKS, **settings}))
    return base


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_stream(spark, sf_dir)
    rows = read_predictions(spark, output_path(base, "predictions"))
    return rows.withColumn("amount_log", F.round("amount_log", 8))


def stream_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_results(spark, output_path(_run_stream(spark, sf_dir), "results"))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_alerts(spark, output_path(_run_stream(spark, sf_dir), "alerts"))


def separate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_stream(spark, sf_dir, fan_out=False, sinks=("predictions",))
    rows = read_predictions(spark, output_path(base, "predictions"))
    return rows.withColumn("amount_log", F.round("amount_log", 8))


def separate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_stream(spark, sf_dir, fan_out=False, sinks=("results",))
    return read_results(spark, output_path(base, "results"))


def separate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_stream(spark, sf_dir, fan_out=False, sinks=("alerts",))
    return read_alerts(spark, output_path(base, "alerts"))


def _write_messages(rows: DataFrame, path: str, batches: int) -> dict[str, str]:
    """Write messages in files of bounded size; returns the source that reads them in ``batches`` batches."""
    files = 2 * max(1, math.ceil(rows.count() / (2 * batches * FILE_MESSAGES)))
    rows.repartition(batches * files).write.parquet(path)
    return {"format": "parquet", "path": path, "maxFilesPerTrigger": str(files)}


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that the job could not take, kept by its quarantine query."""
    base = scratch_path(spark, "stream")
    tampered(spark, sf_dir).write.parquet(f"{base}/messages")
    source = {"format": "parquet", "path": f"{base}/messages"}
    run_job(spark, JobConfig(base, source, sinks=("predictions",), available_now=True, quarantine=True))
    kept = spark.read.schema("value string, reason string, kafka_timestamp timestamp")
    return kept.json(output_path(base, "quarantine")).select("value", "reason", "kafka_timestamp")


def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages given, refused and scored by a job that keeps refused ones apart, over several batches."""
    base = scratch_path(spark, "stream")
    source = _write_messages(tampered(spark, sf_dir), f"{base}/messages", 2)
    run_job(spark, JobConfig(base, source, sinks=("predictions",), available_now=True, quarantine=True))
    snapshot = take_snapshot(spark, base)
    scored = snapshot.rows("predictions").agg(F.count("*").alias("scored")).scalar()
    return state.intake(snapshot.state()).select("messages", "refused", scored.alias("scored"))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged state of a stream of several batches, half of them compacted."""
    base = scratch_path(spark, "stream")
    source = _write_messages(messages(spark, sf_dir), f"{base}/messages", 3)
    run_job(spark, JobConfig(base, source, sinks=("predictions",), available_now=True))
    compact_state(spark, base)
    return take_snapshot(spark, base).state()


def stream_separate_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three file sinks as queries of their own; how many rows each one wrote."""
    base = _run_stream(spark, sf_dir, fan_out=False)
    readers = {"predictions": read_predictions, "results": read_results, "alerts": read_alerts}
    counts = [
        reader(spark, output_path(base, name)).agg(F.lit(name).alias("sink"), F.count("*").alias("n_rows"))
        for name, reader in readers.items()
    ]
    return union_all(counts)


def stream_running_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milestones of a stream whose batches arrive in order of time."""
    base = scratch_path(spark, "stream")
    messages(spark, sf_dir).write.parquet(f"{base}/messages")
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{base}/messages")
    start_running_rate(parse_transactions(stream), base, available_now=True).awaitTermination()
    written = spark.read.parquet(output_path(base, "running"))
    return written.select("transactions", "frauds", "fraud_rate", "is_final")


def stream_running_rate_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milestones of a stream in which messages come up to two days late; those that wait at its end are counted last."""
    base = scratch_path(spark, "stream")
    delayed = messages(spark, sf_dir).withColumn("seen", F.expr("timestamp + make_dt_interval(0, pmod(crc32(value), 48))"))
    before = F.lit("0001-01-01")
    for until in ("2024-01-08", "2024-01-16", "2024-01-24", "9999-12-31"):
        part = delayed.where((F.col("seen") >= before) & (F.col("seen") < until)).drop("seen")
        part.write.mode("append").parquet(f"{base}/messages")
        stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{base}/messages")
        query = start_running_rate(parse_transactions(stream), base, available_now=True, late="2 DAYS")
        query.awaitTermination()  # one batch a part, of however many files
        before = F.lit(until)
    columns = ["transactions", "frauds", "fraud_rate", "is_final"]
    written = spark.read.parquet(output_path(base, "running")).where("NOT is_final").select(*columns)
    return written.unionByName(waiting_rate(spark, base, query.id))


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two streamed halves, the first of them compacted, of the later half of January."""
    base = scratch_path(spark, "stream")
    source = {"format": "parquet", "path": f"{base}/messages"}
    whole = messages(spark, sf_dir)
    for half in ("timestamp < TIMESTAMP '2024-01-20'", "timestamp >= TIMESTAMP '2024-01-20'"):
        whole.where(half).write.mode("append").parquet(f"{base}/messages")
        run_job(spark, JobConfig(base, source, sinks=("predictions", "alerts"), available_now=True))
        compact(spark, base, "predictions")
    rows = read_compacted(spark, base, "predictions", since="2024-01-16")
    return rows.withColumn("amount_log", F.round("amount_log", 8))


def write_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting times of streamed rows, were all of them written at one moment."""
    rows = read_predictions(spark, output_path(_run_stream(spark, sf_dir), "predictions"))
    times = rows.selectExpr("kafka_timestamp AS arrival", "TIMESTAMP '2024-02-01 00:00:00' AS written")
    return monitor.waiting_times(times, accuracy=1_000_000)


def waits_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting times per hour of arrival from merged sketches of two halves, were all rows written at one moment."""
    times = transactions(spark, sf_dir).selectExpr("kafka_timestamp AS arrival", "TIMESTAMP '2024-02-01 00:00:00' AS written", "crc32(transaction_id) % 2 AS half")
    halves = [monitor.wait_sketches(times.where(F.col("half") == half), "1 hour", at="arrival") for half in (0, 1)]
    return monitor.waits_over_time(union_all(halves), "1 hour")


# --- quality -------------------------------------------------------------------------------


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(parse_tampered(spark, sf_dir))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(transactions(spark, sf_dir), "2024-02-01 00:00:00", "location")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction once out of a log that holds every one of them twice."""
    rows = transactions(spark, sf_dir)
    return quality.deduplicate(union_all([rows, rows]))


def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of a stream that is sent the whole log again a year later."""
    base = scratch_path(spark, "stream")
    sent = messages(spark, sf_dir)
    source = {"format": "parquet", "path": f"{base}/messages"}
    for part in (sent, sent.withColumn("timestamp", F.expr("timestamp + INTERVAL 1 YEAR"))):
        part.write.mode("append").parquet(f"{base}/messages")
        run_job(spark, JobConfig(base, source, sinks=("predictions",), available_now=True, dedup_within=quality.ALWAYS))
    rows = read_predictions(spark, output_path(base, "predictions"))
    return rows.withColumn("amount_log", F.round("amount_log", 8))


QUERIES: dict[str, Query] = {
    "parse_transactions": parsed,
    "parse_tampered": parse_tampered,
    "messages_replay": messages_replay,
    "features_time": features_time,
    "features_amount": features_amount,
    "features_text": features_text,
    "features_risk_table": features_risk_table,
    "rule_hits": rule_hits,
    "rules_fired": rules_fired,
    "score_rules": score_rules_query,
    "score_model": score_model_query,
    "score_ensemble": score_ensemble_query,
    "amount_curve": amount_curve,
    "amount_threshold": amount_threshold,
    "model_curve": model_curve,
    "predictions_view": predictions_view,
    "console_view": _on_scored(views.console_view),
    "results_view": _results,
    "alerts_view": _alerts,
    "legitimate_rows": _on_scored(lambda rows: views.legitimate(rows).select("transaction_id", "amount")),
    "alert_cards": alert_cards,
    "coerce_results": coerce_text,
    "summary": _on_scored(report.summary),
    "quality_metrics": _on_scored(report.quality_metrics),
    "kpis": _on_scored(report.kpis),
    "class_split": _on_scored(report.class_split),
    "status_counts": status_counts,
    "amount_histogram": _on_scored(report.amount_histogram),
    "probability_histogram": _on_scored(report.probability_histogram),
    "amount_buckets": _on_scored(report.amount_buckets),
    "top_locations": _on_scored(report.top_locations),
    "top_locations_from_messages": entry_query,
    "recent_alerts": lambda spark, sf_dir: views.recent_alerts(_alerts(spark, sf_dir), 5, with_total=True),
    "recent_alerts_web": lambda spark, sf_dir: views.recent_alerts(_alerts(spark, sf_dir), 4).select(
        "user_id", "amount", "location", "fraud_probability"
    ),
    "recent_transactions": lambda spark, sf_dir: views.recent_transactions(_results(spark, sf_dir)),
    "running_fraud_rate": running_rate,
    "results_roundtrip": results_roundtrip,
    "alerts_roundtrip": alerts_roundtrip,
    "results_other_headers": results_other_headers,
    "union_results": union_results,
    "stream_score": stream_score,
    "stream_results": stream_results,
    "stream_alerts": stream_alerts,
    "stream_separate_sinks": stream_separate_sinks,
    "separate_score": separate_score,
    "separate_results": separate_results,
    "separate_alerts": separate_alerts,
    "stream_quarantine": stream_quarantine,
    "stream_running_rate": stream_running_rate,
    "stream_running_rate_shuffled": stream_running_rate_shuffled,
    "stream_deduplicated": stream_deduplicated,
    "stream_intake": stream_intake,
    "state_summary": lambda spark, sf_dir: state.summary(_state(spark, sf_dir)),
    "state_class_split": lambda spark, sf_dir: state.class_split(_state(spark, sf_dir)),
    "state_amount_buckets": lambda spark, sf_dir: state.amount_buckets(_state(spark, sf_dir)),
    "state_top_locations": lambda spark, sf_dir: state.top_locations(_state(spark, sf_dir)),
    "compacted_predictions": compacted,
    "write_latency": write_latency,
    "waits_by_window": waits_by_window,
    "throughput": lambda spark, sf_dir: monitor.throughput(transactions(spark, sf_dir), "1 hour"),
    "flag_rate_over_time": lambda spark, sf_dir: monitor.flag_rate_over_time(
        _scored(spark, sf_dir), "1 hour"
    ),
    "schema_violations": lambda spark, sf_dir: quality.schema_violations(tampered(spark, sf_dir)),
    "quarantine": lambda spark, sf_dir: quality.quarantine(tampered(spark, sf_dir)).select(
        "value", "reason", "kafka_timestamp"
    ),
    "null_profile": null_profile,
    "freshness": freshness,
    "deduplicated": deduplicated,
}
