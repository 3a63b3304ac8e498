import json

import pytest

from amberline.operators import quality
from amberline.schemas import MESSAGE, struct
from tests.helpers import ARRIVED, frame, tx
from tests.test_decode import GOOD

MESSAGES = {
    "good": (json.dumps(GOOD), None),
    "null": (None, "empty"),
    "blank": ("  ", "empty"),
    "text": ("not json", "not_json"),
    "cut": ('{"user_id": 1', "not_json"),
    "quoted": (json.dumps({**GOOD, "user_id": "7"}), "wrong_type"),
    "only quoted": ('{"user_id": "7"}', "wrong_type"),
    "flag": (json.dumps({**GOOD, "is_fraud": True}), "wrong_type"),
    "foreign": ('{"other": 1}', "no_known_field"),
    "no user": (json.dumps({k: v for k, v in GOOD.items() if k != "user_id"}), None),
    "bad time": (json.dumps({**GOOD, "timestamp": "late"}), None),
    "negative": (json.dumps({**GOOD, "amount": -2}), None),
    "label": (json.dumps({**GOOD, "is_fraud": 2}), None),
}


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(text, ARRIVED) for text, _ in MESSAGES.values()], struct(MESSAGE))


def test_quarantine(messages):
    found = {(r.value, r.reason) for r in quality.quarantine(messages).collect()}
    assert found == {(text, reason) for text, reason in MESSAGES.values() if reason}


def test_violations(messages):
    found = {r.check: r.violations for r in quality.schema_violations(messages).collect()}
    assert {name: n for name, n in found.items() if n} == {
        "empty": 2,
        "not_json": 2,
        "wrong_type": 3,
        "no_known_field": 1,
        "missing_user_id": 1,
        "bad_timestamp": 1,
        "negative_amount": 1,
        "bad_label": 1,
    }
    assert len(found) == 4 + 7 + 3
    assert {r.checked for r in quality.schema_violations(messages).collect()} == {len(MESSAGES)}


def test_null_profile(spark):
    rows = frame(spark, [tx(merchant=None), tx(), tx(amount=None, merchant=None), tx()])
    found = {r.column_name: (r.null_count, r.null_pct) for r in quality.null_profile(rows).collect()}
    assert found["merchant"] == (2, 50.0) and found["amount"] == (1, 25.0) and found["user_id"] == (0, 0.0)


def test_freshness(spark):
    rows = frame(spark, [tx(), tx(kafka_timestamp=ARRIVED.replace(minute=5)), tx(location="Oslo")])
    (overall,) = quality.freshness(rows, "2024-03-10 08:10:00").collect()
    assert overall.age_seconds == 300
    by = {r.location: r.age_seconds for r in quality.freshness(rows, "2024-03-10 08:10:00", "location").collect()}
    assert by == {"Denver": 300, "Oslo": 600}
