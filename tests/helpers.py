from datetime import datetime

from amberline.schemas import PARSED, names, struct

NOON_WEDNESDAY = "2024-03-06T12:00:00"
NOON_FRIDAY = "2024-03-08T12:00:00"
NOON_SATURDAY = "2024-03-09T12:00:00"
ARRIVED = datetime(2024, 3, 10, 8, 0, 0)


def tx(**given):
    row = {
        "transaction_id": "t1",
        "user_id": 1001,
        "amount": 50.0,
        "timestamp": NOON_WEDNESDAY,
        "location": "Denver",
        "merchant": "Acme Ltd",
        "is_fraud": 0,
        "kafka_timestamp": ARRIVED,
    }
    assert set(given) <= set(row)
    return {**row, **given}


def frame(spark, rows):
    ordered = [tuple(row[name] for name in names(PARSED)) for row in rows]
    return spark.createDataFrame(ordered, struct(PARSED))
