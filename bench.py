"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores. Each query runs to
the end on a sink that keeps nothing; its time is the better of two runs after a warm-up of
the session. ``rows_per_sec`` relates decode, features and rules to the rows of ``events``, and
``scaling`` to 1, 4 and 16 times as many messages in as many files, so that all cores have work.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from amberline.operators.decode import parse_transactions, to_messages
from amberline.operators.features import engineer_features
from amberline.operators.scoring import score
from amberline.plans.catalog import QUERIES
from amberline.session import build_session
from amberline.sources.kafka import read_batch
from amberline.sources.tables import transactions

HEADLINE = (
    "parse_transactions",
    "predictions_view",
    "score_rules",
    "alerts_view",
    "summary",
    "kpis",
    "class_split",
    "amount_histogram",
    "probability_histogram",
    "amount_buckets",
    "top_locations",
    "top_locations_from_messages",
    "recent_alerts",
    "recent_transactions",
    "running_fraud_rate",
    "results_roundtrip",
    "alerts_roundtrip",
    "stream_score",
    "stream_alerts",
    "schema_violations",
    "throughput",
)


def run_once(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def scaling(spark, sf_dir: str, folder: str) -> dict[str, int]:
    """Messages decoded, given features and scored per second, by how many copies of all messages there are."""
    found = {}
    for copies in (1, 4, 16):
        sent = to_messages(transactions(spark, sf_dir)).selectExpr("CAST(value AS STRING) AS value", "timestamp")
        path = f"{folder}/messages-{copies}"
        sent = sent.selectExpr("*", f"explode(sequence(1, {copies})) AS copy").drop("copy")
        sent.repartition(4 * copies).write.parquet(path)
        stored = read_batch(spark, {"format": "parquet", "path": path})
        rows = stored.count()
        started = time.perf_counter()
        scored = score(engineer_features(parse_transactions(stored, guard=False)))
        scored.write.format("noop").mode("overwrite").save()
        found[str(copies)] = round(rows / (time.perf_counter() - started))
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=folder,
    )
    spark.sparkContext.setLogLevel("ERROR")
    to_messages(transactions(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    seconds = {name: min(run_once(spark, QUERIES[name], sf_dir) for _ in range(2)) for name in HEADLINE}
    events = transactions(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": events,
                "rows_per_sec": {
                    "batch_decode_to_score": round(events / seconds["predictions_view"]),
                    "stream_to_three_sinks": round(events / seconds["stream_score"]),
                },
                "scaling": scaling(spark, sf_dir, folder),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
