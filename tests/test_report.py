import numpy as np
import pytest

from amberline.operators import report, views
from amberline.operators.features import engineer_features
from amberline.operators.scoring import score_rules
from tests.helpers import ARRIVED, frame, tx


def scored(spark, rows):
    return score_rules(engineer_features(frame(spark, rows)))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    rows = [
        tx(
            transaction_id=str(i),
            amount=None if i % 31 == 0 else float("nan") if i % 37 == 0 else float(rng.integers(0, 800_000)) / 100,
            location=[None, "Lagos", "Denver", "Oslo"][i % 4],
            is_fraud=int(i % 9 == 0),
        )
        for i in range(500)
    ]
    return scored(spark, rows).cache()


def test_summary_against_pandas(mixed):
    pdf = mixed.toPandas()
    flagged = pdf[pdf.is_fraud_predicted == 1]
    hits = int((flagged.is_fraud == 1).sum())
    row = report.summary(mixed).first()
    assert row.total_transactions == 500
    assert row.fraud_detected == len(flagged)
    assert row.actual_fraud == int((pdf.is_fraud == 1).sum())
    assert row.true_positives == hits
    assert row.precision == hits / len(flagged)
    assert row.recall == hits / row.actual_fraud
    assert row.fraud_detected_pct == round(100 * len(flagged) / 500, 1)
    assert row.total_amount == round(pdf.amount.sum(), 2)
    assert row.fraud_amount == round(flagged.amount.sum(), 2)
    assert row.avg_amount == round(pdf.amount.mean(), 2)
    assert row.avg_fraud_amount == round(flagged.amount.mean(), 2)
    tiles = report.kpis(mixed).first()
    assert (tiles.total_transactions, tiles.fraud_detected) == (500, len(flagged))
    assert tiles.total_amount == round(row.total_amount)


def test_summary_of_nothing(spark):
    row = report.summary(scored(spark, [])).first()
    assert (row.total_transactions, row.fraud_detected, row.true_positives) == (0, 0, 0)
    assert row.precision is None and row.recall is None and row.fraud_detected_pct is None
    assert row.total_amount == 0 and row.avg_amount is None and row.avg_fraud_amount is None
    assert report.class_split(scored(spark, [])).count() == 0
    assert report.amount_histogram(scored(spark, [])).count() == 0
    assert report.top_locations(scored(spark, [])).count() == 0
    assert [r.legitimate for r in report.amount_buckets(scored(spark, [])).collect()] == [0] * 6


def test_precision_needs_both_kinds(spark):
    row = report.quality_metrics(scored(spark, [tx(amount=9000.0)])).first()
    assert (row.fraud_detected, row.actual_fraud, row.precision, row.recall) == (1, 0, None, None)


def test_huge_and_infinite_amounts_are_counted(spark):
    row = report.summary(scored(spark, [tx(amount=1e15), tx(amount=2.5)])).first()
    assert row.total_amount == 1e15 + 2.5
    assert report.summary(scored(spark, [tx(amount=float("inf"))])).first().total_amount == float("inf")


@pytest.mark.parametrize(("amount", "n", "total"), [(0.004, 1000, 4.0), (9e12, 20_000, 1.8e17), (1.1e13, 20_000, 2.2e17)])
def test_amounts_are_not_rounded_before_they_are_summed(spark, amount, n, total):
    rows = spark.range(n).selectExpr(f"{amount}D AS amount", "0 AS is_fraud_predicted", "0 AS is_fraud")
    assert report.summary(rows).first().total_amount == pytest.approx(total, rel=1e-12)
    assert report.kpis(rows).first().total_amount == pytest.approx(total, rel=1e-12)


def test_infinite_values_are_in_no_bin(spark):
    values = [*map(float, range(9)), float("inf"), float("-inf")]
    rows = report.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 3).orderBy("bin").collect()
    assert [r.n for r in rows] == [3, 3, 3] and (rows[0].lower, rows[-1].upper) == (0.0, 8.0)


def test_class_labels_follow_the_class(spark):
    rows = scored(spark, [tx(amount=9000.0)] * 3 + [tx()])
    found = {r.is_fraud_predicted: (r.label, r.transactions, r.share_pct) for r in report.class_split(rows).collect()}
    assert found == {0: ("Legitimate", 1, 25.0), 1: ("Fraudulent", 3, 75.0)}
    only = report.class_split(scored(spark, [tx()])).collect()
    assert [(r.label, r.share_pct) for r in only] == [("Legitimate", 100.0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.uniform(-3, 9, 700), rng.integers(0, 3))
    edges = np.linspace(values.min(), values.max(), 13)
    values = np.concatenate([values, edges])  # values that sit right on an edge
    counts, bounds = np.histogram(values, bins=12)
    frame_ = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    rows = report.histogram(frame_, "v", 12).orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert [r.lower for r in rows] + [rows[-1].upper] == pytest.approx(bounds.tolist(), abs=0)


def test_histogram_classes_share_bins(mixed):
    pdf = mixed.toPandas().dropna(subset=["amount"])
    bounds = np.histogram_bin_edges(pdf.amount, bins=30)
    rows = report.amount_histogram(mixed).orderBy("is_fraud_predicted", "bin").collect()
    for cls in (0, 1):
        counts, _ = np.histogram(pdf[pdf.is_fraud_predicted == cls].amount, bins=bounds)
        assert [r.n for r in rows if r.is_fraud_predicted == cls] == counts.tolist()
    assert sum(r.n for r in rows) == len(pdf)


def test_histogram_of_one_value_and_given_bounds(spark):
    same = spark.createDataFrame([(4.0,)] * 5, "v double")
    rows = report.histogram(same, "v", 10).orderBy("bin").collect()
    assert (rows[0].lower, rows[-1].upper) == (3.5, 4.5)
    assert [r.n for r in rows] == np.histogram([4.0] * 5, bins=10)[0].tolist()
    some = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,), (11.0,)], "v double")
    rows = report.histogram(some, "v", 2, bounds=(0, 10)).orderBy("bin").collect()
    assert [(r.lower, r.upper, r.n) for r in rows] == [(0, 5, 2), (5, 10, 2)]


def test_buckets(spark):
    amounts = [0.0, 99.99, 100.0, 499.99, 500.0, 1000.0, 4999.99, 5000.0, 5000.01, -1.0, None, float("nan")]
    rows = report.amount_buckets(scored(spark, [tx(amount=a) for a in amounts])).orderBy("bucket_no").collect()
    assert [r.bucket for r in rows] == ["$0-100", "$100-500", "$500-1K", "$1K-5K", "$5K+", "other"]
    assert [r.legitimate + r.fraudulent for r in rows] == [2, 2, 1, 2, 2, 3]


def test_top_locations_order_and_ties(spark):
    rows = [tx(location=p, amount=9000.0) for p in ["b", "a", "c", "c", None]] + [tx(location="z")]
    found = report.top_locations(scored(spark, rows), 2).collect()
    assert [(r.location, r.fraud_count) for r in found] == [("c", 2), ("a", 1)]


def test_recent_lists(spark):
    later = ARRIVED.replace(hour=9)
    rows = scored(
        spark,
        [tx(transaction_id="b", amount=9000.0), tx(transaction_id="a", amount=9000.0)]
        + [tx(transaction_id="n", amount=8000.456, kafka_timestamp=later), tx(transaction_id="ok")],
    )
    newest = views.recent_alerts(views.alerts_view(rows), 2, with_total=True).collect()
    assert [(r.transaction_id, r.total_alerts) for r in newest] == [("n", 3), ("a", 3)]
    shown = views.recent_transactions(views.results_view(rows), 2).collect()
    assert [(r.amount, r.status) for r in shown] == [(8000.46, "FRAUD"), (9000.0, "FRAUD")]


def test_alert_card_defaults(spark):
    bare = views.alerts_view(scored(spark, [tx(transaction_id=None, amount=float("nan"), location="Lagos", user_id=None)]))
    (card,) = views.alert_card(bare.drop("amount").selectExpr("*", "CAST(NULL AS DOUBLE) AS amount")).collect()
    assert (card.transaction_id, card.user_id, card.amount, card.location) == ("N/A", "N/A", 0.0, "Lagos")
