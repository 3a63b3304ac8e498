"""Report figures over scored or result rows, each one aggregation pass.

All group-bys have few groups or pre-aggregate before the shuffle, so a hot class, bucket or
location costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import (
    aliased,
    amount_count,
    amount_sum,
    money,
    percent,
    ratio,
    text,
)

_FLAGGED = "is_fraud_predicted = 1"
_LABELLED = "is_fraud = 1"

_COUNTS = {
    "total_transactions": "count(*)",
    "fraud_detected": f"count_if({_FLAGGED})",
    "actual_fraud": f"count_if({_LABELLED})",
    "true_positives": f"count_if({_FLAGGED} AND {_LABELLED})",
}


def _if_both(share: str) -> str:
    return f"CASE WHEN fraud_detected > 0 AND actual_fraud > 0 THEN {share} END"


_PRECISION = f"{_if_both(ratio('true_positives', 'fraud_detected'))} AS precision"
_RECALL = f"{_if_both(ratio('true_positives', 'actual_fraud'))} AS recall"


def summary(df: DataFrame) -> DataFrame:
    """One row of counts, shares, precision, recall and amounts; null where undefined."""
    amounts = {
        "total": amount_sum(),
        "flagged": amount_sum(within=_FLAGGED),
        "n_amounts": amount_count(),
        "n_flagged_amounts": amount_count(within=_FLAGGED),
    }
    return summary_of(df.selectExpr(*aliased(_COUNTS), *aliased(amounts)))


def summary_of(totals: DataFrame) -> DataFrame:
    """The summary, from one row of counts and sums."""
    return totals.selectExpr(
        "total_transactions",
        "fraud_detected",
        f"{percent('fraud_detected', 'total_transactions')} AS fraud_detected_pct",
        "actual_fraud",
        f"{percent('actual_fraud', 'total_transactions')} AS actual_fraud_pct",
        "true_positives",
        _PRECISION,
        _RECALL,
        f"{money('total')} AS total_amount",
        f"{money('flagged')} AS fraud_amount",
        f"{money(ratio('total', 'n_amounts'))} AS avg_amount",
        f"{money(ratio('flagged', 'n_flagged_amounts'))} AS avg_fraud_amount",
    )


def quality_metrics(df: DataFrame) -> DataFrame:
    """Precision and recall of the prediction against the label, with their counts."""
    counted = df.selectExpr(*aliased(_COUNTS))
    return counted.selectExpr("fraud_detected", "actual_fraud", "true_positives", _PRECISION, _RECALL)


def kpis(df: DataFrame) -> DataFrame:
    """The headline tiles: total, flagged, flagged share and volume in whole currency units."""
    totals = df.selectExpr(*aliased(_COUNTS), f"{amount_sum()} AS volume")
    return totals.selectExpr(
        "total_transactions",
        "fraud_detected",
        f"{percent('fraud_detected', 'total_transactions')} AS fraud_rate",
        f"{money('volume', 0)} AS total_amount",
    )


# The names shown for the predicted classes.
CLASS_LABELS = {0: "Legitimate", 1: "Fraudulent"}


def class_split(df: DataFrame) -> DataFrame:
    """Rows per predicted class with their share of the classified rows; absent classes are left out."""
    counts = {name: f"count_if(is_fraud_predicted = {value})" for value, name in CLASS_LABELS.items()}
    return class_split_of(df.selectExpr(*aliased(counts)))


def class_split_of(counted: DataFrame) -> DataFrame:
    """The split, from one row of counts by label."""
    classified = f"({' + '.join(CLASS_LABELS.values())})"
    rows = ", ".join(
        f"struct({value} AS is_fraud_predicted, {text(name)} AS label, {name} AS transactions, "
        f"{percent(name, classified)} AS share_pct)"
        for value, name in CLASS_LABELS.items()
    )
    return counted.selectExpr(f"inline(array({rows}))").where("transactions > 0")


def top_locations(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` locations with most flagged rows; ties by name."""
    flagged = df.where(f"{_FLAGGED} AND location IS NOT NULL")
    counted = flagged.groupBy("location").agg(F.count("*").alias("fraud_count"))
    return counted.orderBy(F.desc("fraud_count"), "location").limit(k)


# Equal ends are moved half a unit apart each, so a constant column has a range too.
_SPAN = """struct(lo - CASE WHEN lo = hi THEN 0.5D ELSE 0D END AS lo,
                  hi + CASE WHEN lo = hi THEN 0.5D ELSE 0D END AS hi) AS span"""


def _span_of(values: DataFrame, bounds: tuple[float, float] | None) -> Column:
    if bounds:
        return F.expr(f"struct({float(bounds[0])}D AS lo, {float(bounds[1])}D AS hi)")
    return values.selectExpr("min(x) AS lo", "max(x) AS hi").selectExpr(_SPAN).scalar()


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    by: str | None = None,
    classes: tuple[int, ...] = (0, 1),
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width counts of ``column``: rows (bin, lower, upper[, by], n), empty bins included.

    Bins are closed on the left, the last on both sides. All classes of ``by`` share one range:
    ``bounds``, or else the column's own minimum and maximum, which takes a second scan that
    reads the needed columns only. Null, NaN and infinite values, and values outside ``bounds``,
    are in no bin.
    """
    # Each (bin, class) is a cell number; what belongs to none is cell -1, which no row of the
    # frame below matches. A filter, or a key that can be null, would be pushed below the
    # projections and compute the column again.
    value = f"nanvl(CAST(`{column}` AS DOUBLE), CAST(NULL AS DOUBLE))"
    value = f"CASE WHEN abs({value}) < CAST('Infinity' AS DOUBLE) THEN {value} END"
    if bounds:
        low, high = (f"{float(end)}D" for end in bounds)
        value = f"CASE WHEN {value} BETWEEN {low} AND {high} THEN {value} END"
    groups = list(classes) if by else [0]
    group = "0"
    if by:
        ranks = " ".join(f"WHEN {cls} THEN {rank}" for rank, cls in enumerate(groups))
        group = f"CASE `{by}` {ranks} ELSE -1 END"
        value = f"CASE WHEN `{by}` IN ({', '.join(map(str, groups))}) THEN {value} END"
    values = df.selectExpr(f"{value} AS x", f"{group} AS c")
    span = _span_of(values, bounds)

    def edge(index: str) -> str:
        return (
            f"CASE WHEN {index} = {bins} THEN span.hi "
            f"ELSE span.lo + {index} * ((span.hi - span.lo) / {bins}) END"
        )

    # The division can land one bin off by a rounding error; the edges decide.
    place = f"floor((x - span.lo) / ((span.hi - span.lo) / {bins}))"
    guess = f"CAST(CASE WHEN x IS NOT NULL THEN least({place}, {bins - 1}) END AS INT)"
    slot = (
        f"CASE WHEN x < {edge('g')} THEN g - 1 "
        f"WHEN g < {bins - 1} AND x >= {edge('(g + 1)')} THEN g + 1 ELSE g END"
    )
    guessed = values.withColumn("span", span).selectExpr("x", "c", "span", f"{guess} AS g")
    cells = guessed.selectExpr(f"coalesce(({slot}) * {len(groups)} + c, -1) AS cell")
    counted = cells.groupBy("cell").agg(F.count("*").alias("n"))

    # At most bins x classes + 1 rows on either side of this join.
    frame = df.sparkSession.range(0, bins * len(groups), 1, 1).selectExpr("CAST(id AS INT) AS cell")
    filled = frame.join(F.broadcast(counted), "cell", "left").withColumn("span", span)
    in_order = ", ".join(map(str, groups))
    placed = filled.where("span.lo IS NOT NULL").selectExpr(
        "*",
        f"cell DIV {len(groups)} AS b",
        f"element_at(array({in_order}), cell % {len(groups)} + 1) AS cls",
    )
    return placed.selectExpr(
        "CAST(b AS INT) AS bin",
        f"{edge('b')} AS lower",
        f"{edge('(b + 1)')} AS upper",
        *([f"cls AS `{by}`"] if by else []),
        "coalesce(n, 0L) AS n",
    )


def amount_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df, "amount", bins, by="is_fraud_predicted")


def probability_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(df, "fraud_probability", bins)


# Bucket labels and their lower edges.
AMOUNT_BUCKETS: tuple[tuple[str, int], ...] = (
    ("$0-100", 0),
    ("$100-500", 100),
    ("$500-1K", 500),
    ("$1K-5K", 1000),
    ("$5K+", 5000),
)
OTHER_BUCKET = "other"


def bucket_no() -> Column:
    """The number of an amount's bucket; null, NaN and negative amounts are in the last one."""
    other = len(AMOUNT_BUCKETS)
    downwards = " ".join(f"WHEN amount >= {low} THEN {index}" for index, (_, low) in reversed(list(enumerate(AMOUNT_BUCKETS))))
    return F.expr(f"CASE WHEN isnan(amount) THEN {other} {downwards} ELSE {other} END")


def amount_buckets(df: DataFrame) -> DataFrame:
    """Legitimate and fraudulent rows per amount bucket, in bucket order, empty ones included.

    Buckets are closed on the left. Null, NaN and negative amounts are counted as ``other``.
    """
    placed = df.select(bucket_no().alias("bucket_no"), "is_fraud_predicted")
    counted = placed.groupBy("bucket_no").agg(
        F.expr("count_if(is_fraud_predicted = 0) AS legitimate"),
        F.expr(f"count_if({_FLAGGED}) AS fraudulent"),
    )
    return amount_buckets_of(counted)


def amount_buckets_of(counted: DataFrame) -> DataFrame:
    """All buckets, from the counts of those that have any."""
    labels = [label for label, _ in AMOUNT_BUCKETS] + [OTHER_BUCKET]
    frame = counted.sparkSession.range(0, len(labels), 1, 1).selectExpr("CAST(id AS INT) AS bucket_no")
    return frame.join(F.broadcast(counted), "bucket_no", "left").selectExpr(
        "bucket_no",
        f"element_at(array({', '.join(map(text, labels))}), bucket_no + 1) AS bucket",
        "coalesce(legitimate, 0L) AS legitimate",
        "coalesce(fraudulent, 0L) AS fraudulent",
    )
