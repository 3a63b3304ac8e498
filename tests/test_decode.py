import json

import pytest

from amberline.operators.decode import parse_transactions, to_messages
from amberline.schemas import MESSAGE, PARSED, TRANSACTION, names, struct
from tests.helpers import ARRIVED, frame, tx

GOOD = {
    "transaction_id": "a",
    "user_id": 7,
    "amount": 12.5,
    "timestamp": "2024-03-06T12:00:00",
    "location": "Lagos",
    "merchant": "Smith, Jones",
    "is_fraud": 1,
}


def parse(spark, *values, guard=True):
    messages = spark.createDataFrame([(value, ARRIVED) for value in values], struct(MESSAGE))
    return parse_transactions(messages, guard=guard).collect()


@pytest.mark.parametrize("guard", [True, False])
def test_good_message(spark, guard):
    (row,) = parse(spark, json.dumps({**GOOD, "extra": 1}), guard=guard)
    assert row.asDict() == {**GOOD, "kafka_timestamp": ARRIVED}
    assert list(row.asDict()) == names(PARSED)


@pytest.mark.parametrize("guard", [True, False])
@pytest.mark.parametrize("value", ["not json", "", None, "[{},{}]", '[{"user_id":1},{"user_id":2}]', '{"user_id": 1'])
def test_bad_message_is_a_row_of_nulls(spark, value, guard):
    (row,) = parse(spark, value, guard=guard)
    assert [row[name] for name in names(TRANSACTION)] == [None] * 7
    assert row.kafka_timestamp == ARRIVED


@pytest.mark.parametrize("guard", [True, False])
@pytest.mark.parametrize(
    ("field", "value"),
    [
        ("is_fraud", True),
        ("user_id", "12"),
        ("user_id", 12.5),
        ("user_id", 3_000_000_000),
        ("amount", "7.5"),
    ],
)
def test_wrong_type_spoils_only_its_field(spark, field, value, guard):
    (row,) = parse(spark, json.dumps({**GOOD, field: value}), guard=guard)
    assert row[field] is None
    assert all(row[name] == GOOD[name] for name in GOOD if name != field)


def test_number_in_text_field_and_key_case(spark):
    (row,) = parse(spark, json.dumps({**GOOD, "merchant": 5, "USER_ID": 9}))
    assert row.merchant == "5" and row.user_id == 7


def test_round_trip_keeps_every_field(spark):
    rows = [tx(merchant='Smith, Jones "and" Co'), tx(transaction_id="t2", amount=None, merchant="café")]
    source = frame(spark, rows)
    back = parse_transactions(to_messages(source))
    assert sorted(back.collect()) == sorted(source.collect())


def test_filter_does_not_repeat_the_parse(spark):
    messages = spark.createDataFrame([(json.dumps(GOOD), ARRIVED)], struct(MESSAGE))
    plan = parse_transactions(messages).where("amount > 1 AND location = 'Lagos'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
