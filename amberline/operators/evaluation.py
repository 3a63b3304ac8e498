"""How well a score tells frauds: a holdout by id, the exact precision/recall curve, and the best threshold of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import ratio
from amberline.session import scratch_path

#: Below every score, so that all rows are flagged.
FLOOR = -1.0
CURVE = ["threshold", "flagged", "true_positives", "precision", "recall", "f1"]


def in_holdout(percent: int = 20, key: str = "transaction_id") -> str:
    """A condition that holds for about ``percent`` of the ids; copies of an id fall on one side, null ids in no holdout."""
    return f"coalesce(pmod(CAST(conv(substring(md5(`{key}`), 1, 8), 16, 10) AS BIGINT), 100) < {percent}, false)"


def precision_recall(
    df: DataFrame,
    score: str = "fraud_probability",
    label: str = "is_fraud",
    partitions: int | None = None,
    work: str | None = None,
) -> DataFrame:
    """One row per threshold: each score that occurs, and ``FLOOR``, which flags all rows.

    A row is flagged when its score is *above* the threshold, as the scorers do it. ``f1`` is
    2 * true positives / (flagged + frauds); ratios without a denominator are null. Rows with a null
    score or label are left out, NaN stands above all numbers, and without rows there is only ``FLOOR``.

    Equal scores are counted to one row before any ordering, so a score that most rows share is one
    row. These are dealt into ranges of the score and numbered inside their range; what stands
    above a range comes from the ranges' totals (one row each, broadcast). They are written to
    ``work``, by default a fresh scratch folder, so that ranges cannot change between the two uses.
    """
    spark = df.sparkSession
    slots = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.selectExpr(f"CAST(`{score}` AS DOUBLE) AS threshold", f"CAST(`{label}` AS LONG) AS y").where("threshold IS NOT NULL AND y IS NOT NULL")
    # 0.0 + x makes one value of the two zeros.
    counted = rows.groupBy(F.expr("0D + threshold").alias("threshold")).agg(F.count("*").alias("n"), F.sum("y").alias("frauds"))
    floor = spark.range(1).selectExpr(f"{FLOOR}D AS threshold", "0L AS n", "0L AS frauds")
    path = work or scratch_path(spark, "curve")
    (
        counted.unionByName(floor).groupBy("threshold").agg(F.sum("n").alias("n"), F.sum("frauds").alias("frauds"))
        .repartitionByRange(slots, F.desc("threshold"))
        .select(F.spark_partition_id().alias("slot"), "*")
        .write.mode("overwrite").parquet(path)
    )
    dealt = spark.read.schema("slot int, threshold double, n long, frauds long").parquet(path)

    # One row per slot, so this single-task window sorts at most ``slots`` rows.
    totals = dealt.groupBy("slot").agg(F.sum("n").alias("slot_n"), F.sum("frauds").alias("slot_frauds"))
    above = "OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = totals.selectExpr(
        "slot",
        f"coalesce(sum(slot_n) {above}, 0L) AS n_before",
        f"coalesce(sum(slot_frauds) {above}, 0L) AS frauds_before",
        "sum(slot_frauds) OVER () AS all_frauds",
    )
    within = "OVER (PARTITION BY slot ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = dealt.join(F.broadcast(starts), "slot").selectExpr(
        "threshold",
        f"n_before + coalesce(sum(n) {within}, 0L) AS flagged",
        f"frauds_before + coalesce(sum(frauds) {within}, 0L) AS true_positives",
        "all_frauds",
    )
    return placed.selectExpr(
        "threshold",
        "flagged",
        "true_positives",
        f"{ratio('true_positives', 'flagged')} AS precision",
        f"{ratio('true_positives', 'all_frauds')} AS recall",
        f"{ratio('2 * true_positives', '(flagged + all_frauds)')} AS f1",
    )


def best_threshold(curve: DataFrame, least_precision: float | None = None) -> DataFrame:
    """The row of the curve with the highest f1, or the highest recall at ``least_precision``; ties to the higher threshold.

    No row when no threshold reaches that precision, or when there are no frauds.
    """
    if least_precision is None:
        wanted, rank = curve.where("f1 > 0"), "f1"
    else:
        wanted, rank = curve.where(f"precision >= {least_precision}D AND true_positives > 0"), "recall"
    top = wanted.agg(F.max_by(F.struct(*CURVE), F.struct(rank, "threshold")).alias("r"))
    return top.where("r IS NOT NULL").select("r.*")
