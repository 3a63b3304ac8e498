"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract
from amberline.operators.features import engineer_features, flag_risky_locations
from amberline.operators.quality import deduplicate
from amberline.operators.report import kpis, top_locations
from amberline.operators.scoring import score_rules
from amberline.operators.views import alerts_view
from amberline.plans.catalog import QUERIES, parsed, tampered
from amberline.sources.tables import transactions

LAZY = sorted(
    set(QUERIES)
    - {name for name in QUERIES if name.startswith(("stream", "separate"))}
    - {"score_model", "score_ensemble", "compacted_predictions", "write_latency"}
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, data, name):
    plan = plan_of(contract.queries()[name](spark, data))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_scoring_is_one_narrow_stage(spark, data):
    plan = plan_of(score_rules(engineer_features(transactions(spark, data))))
    assert "Exchange" not in plan and "Sort" not in plan


def test_reports_read_only_their_columns(spark, data, tmp_path):
    path = str(tmp_path / "p")
    score_rules(engineer_features(transactions(spark, data))).write.parquet(path)
    stored = spark.read.parquet(path)
    schema = re.search(r"ReadSchema: (\S+)", plan_of(kpis(stored))).group(1)
    assert schema == "struct<amount:double,is_fraud_predicted:int>"
    plan = plan_of(alerts_view(stored))
    assert "EqualTo(is_fraud_predicted,1)" in plan
    assert "merchant_length" not in re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "TakeOrderedAndProject" in plan_of(top_locations(stored))


def test_messages_are_parsed_once(spark, data):
    deduplicated = deduplicate(parsed(spark, data))
    for frame in (*(QUERIES[name](spark, data) for name in ("top_locations_from_messages", "schema_violations")), deduplicated):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("parquet") == 1


def test_risk_table_is_computed_once_and_needs_no_job(spark, data):
    tracker = spark.sparkContext.statusTracker()
    rows = transactions(spark, data)
    spark.sparkContext.setJobGroup("planning", "plans only")
    plan = flag_risky_locations(rows, rows.groupBy("location").count())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tampered(spark, data).count() == transactions(spark, data).count()


@pytest.mark.parametrize("name", ["amount_histogram", "probability_histogram", "amount_buckets"])
def test_derived_columns_are_not_computed_again_for_a_filter(spark, data, name):
    plan = contract.queries()[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if re.search(r"\bFilter\b", line)]
    assert all("scalar-subquery" in line and len(line) < 120 for line in filters), filters
