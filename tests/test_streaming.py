from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from amberline.operators.decode import parse_transactions, to_messages
from amberline.operators.features import engineer_features
from amberline.operators.quality import ALWAYS, deduplicate
from amberline.operators.scoring import score_rules
from amberline.operators.views import alerts_view, results_view
from amberline.schemas import MESSAGE, ddl
from amberline.sources import kafka
from amberline.sources.files import read_alerts, read_predictions, read_results
from amberline.sources.kafka import read_batch, read_stream
from amberline.streaming import monitor, state
from amberline.streaming.compaction import compact_state
from amberline.streaming.run import JobConfig, run_job, start_job, wait_for
from amberline.streaming.sinks import SINKS, start_sinks
from tests.helpers import ARRIVED, frame, tx


FILES = ("predictions", "results", "alerts")


def send(spark, folder, rows, extra=()):
    messages = to_messages(frame(spark, rows)).selectExpr("CAST(value AS STRING) AS value", "timestamp")
    if extra:
        broken = spark.createDataFrame([(text, ARRIVED) for text in extra], ddl(MESSAGE))
        messages = messages.unionByName(broken)
    messages.coalesce(1).write.mode("append").parquet(str(folder))


def batch_of(start, n=20):
    return [
        tx(transaction_id=f"{i:03}", amount=float(i * 100), location="Lagos" if i % 5 == 0 else "Denver")
        for i in range(start, start + n)
    ]


def source_of(folder, **more):
    return {"format": "parquet", "path": str(folder), **more}


def rows_of(df):
    return sorted(map(str, df.collect()))


def expected(spark, folder):
    messages = read_batch(spark, source_of(folder))
    return score_rules(engineer_features(parse_transactions(messages)))


@pytest.mark.parametrize("fan_out", [True, False])
def test_stream_equals_batch_and_restarts(spark, tmp_path, fan_out):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0), extra=["not json", None])
    send(spark, inbox, batch_of(20))
    config = JobConfig(
        base,
        source_of(inbox, maxFilesPerTrigger="1"),
        fan_out=fan_out,
        sinks=("predictions", "results", "alerts"),
        available_now=True,
    )
    run_job(spark, config)
    send(spark, inbox, batch_of(40))
    run_job(spark, config)  # goes on from its checkpoint
    run_job(spark, config)  # nothing new
    want = expected(spark, inbox)
    assert want.count() == 62
    assert rows_of(read_predictions(spark, f"{base}/predictions")) == rows_of(want)
    assert rows_of(read_results(spark, f"{base}/results")) == rows_of(results_view(want))
    assert rows_of(read_alerts(spark, f"{base}/alerts")) == rows_of(alerts_view(want))


def test_batch_that_failed_half_way_is_written_once(spark, tmp_path, monkeypatch):
    from amberline.streaming import fanout

    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0))
    send(spark, inbox, batch_of(20))
    config = JobConfig(base, source_of(inbox, maxFilesPerTrigger="1"), sinks=FILES, available_now=True)
    calls = []

    def failing_once(scored):
        calls.append(scored)
        if len(calls) == 2:
            raise RuntimeError("lost on purpose")
        return alerts_view(scored)

    monkeypatch.setattr(fanout, "alerts_view", failing_once)
    with pytest.raises(StreamingQueryException, match="lost on purpose"):
        run_job(spark, config)
    run_job(spark, config)
    assert len(calls) == 3
    want = expected(spark, inbox)
    assert rows_of(read_predictions(spark, f"{base}/predictions")) == rows_of(want)
    assert rows_of(read_results(spark, f"{base}/results")) == rows_of(results_view(want))
    assert rows_of(read_alerts(spark, f"{base}/alerts")) == rows_of(alerts_view(want))


def test_console(spark, tmp_path, capfd):
    inbox = tmp_path / "in"
    send(spark, inbox, batch_of(0, 3))
    source = source_of(inbox)
    config = JobConfig(str(tmp_path / "a"), source, fan_out=False, sinks=("console",), available_now=True)
    (query,) = start_job(spark, config)
    wait_for([query])
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 3
    run_job(spark, JobConfig(str(tmp_path / "b"), source, available_now=True))
    assert "fraud_probability" in capfd.readouterr().out


def test_sink_table():
    assert {name: (sink.format, sink.every) for name, sink in SINKS.items()} == {
        "console": ("console", "10 seconds"),
        "predictions": ("parquet", "30 seconds"),
        "results": ("csv", "20 seconds"),
        "alerts": ("json", "5 seconds"),
    }


def test_processing_time_trigger_runs_until_stopped(spark, tmp_path):
    inbox = tmp_path / "in"
    send(spark, inbox, batch_of(0, 4))
    queries = start_job(spark, JobConfig(str(tmp_path / "o"), source_of(inbox), sinks=FILES, every="1 second"))
    try:
        queries[0].processAllAvailable()
        assert queries[0].isActive
    finally:
        queries[0].stop()
    assert read_predictions(spark, str(tmp_path / "o" / "predictions")).count() == 4


def test_failure_of_any_query_stops_all_and_is_raised(spark, tmp_path):
    inbox = tmp_path / "in"
    send(spark, inbox, batch_of(0, 4))
    stream = read_stream(spark, source_of(inbox))
    good = start_sinks(expected_stream(stream), str(tmp_path / "o"), ["predictions"])
    failing = stream.selectExpr("raise_error('broken on purpose') AS x").writeStream.format("noop").start()
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        wait_for([*good, failing])
    assert not good[0].isActive


def expected_stream(stream):
    return score_rules(engineer_features(parse_transactions(stream)))


def test_model_on_a_stream(spark, tmp_path):
    from amberline.operators.scoring import train_model

    inbox = tmp_path / "in"
    rows = [{**row, "is_fraud": i % 2} for i, row in enumerate(batch_of(0))]
    send(spark, inbox, rows)
    train_model(engineer_features(frame(spark, rows))).save(str(tmp_path / "m"))
    base = str(tmp_path / "o")
    run_job(
        spark,
        JobConfig(base, source_of(inbox), model_path=str(tmp_path / "m"), sinks=FILES, available_now=True),
    )
    out = read_predictions(spark, f"{base}/predictions")
    assert out.count() == 20 and {r.prediction_method for r in out.collect()} == {"model"}


def test_stream_dedup_keeps_rows_without_id(spark, tmp_path):
    inbox, base = tmp_path / "in", str(tmp_path / "o")
    send(spark, inbox, batch_of(0, 5), extra=["bad", "bad"])
    send(spark, inbox, batch_of(3, 5))
    config = JobConfig(base, source_of(inbox, maxFilesPerTrigger="1"), sinks=FILES, available_now=True, dedup_within="1 hour")
    run_job(spark, config)
    ids = [r.transaction_id for r in read_predictions(spark, f"{base}/predictions").collect()]
    assert sorted(i for i in ids if i) == [f"{i:03}" for i in range(8)]
    assert ids.count(None) == 2


def test_batch_dedup(spark):
    rows = frame(spark, batch_of(0, 4) * 3 + [tx(transaction_id=None)] * 3)
    assert deduplicate(rows).count() == 4 + 3
    late = ARRIVED.replace(hour=9)
    twice = frame(spark, [tx(amount=1.0, kafka_timestamp=late), tx(amount=2.0), tx(amount=3.0, kafka_timestamp=late)])
    (kept,) = deduplicate(twice).collect()
    assert (kept.amount, kept.kafka_timestamp) == (2.0, ARRIVED)


def test_json_message_files(spark, tmp_path):
    messages = to_messages(frame(spark, batch_of(0, 3))).selectExpr("CAST(value AS STRING) AS value", "timestamp")
    messages.write.json(str(tmp_path / "j"))
    back = parse_transactions(read_batch(spark, {"format": "json", "path": str(tmp_path / "j")}))
    assert rows_of(back) == rows_of(frame(spark, batch_of(0, 3)))


def test_windows_on_a_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    send(spark, inbox, batch_of(0, 6))
    rates = monitor.flag_rate_over_time(expected_stream(read_stream(spark, source_of(inbox))))
    query = rates.writeStream.outputMode("complete").format("memory").queryName("rates").trigger(availableNow=True).start()
    query.awaitTermination()
    (row,) = spark.table("rates").collect()
    assert (row.window_start, row.transactions, row.flagged, row.flag_rate) == (ARRIVED, 6, 2, 33.3)


def test_windows_in_batch(spark):
    rows = frame(spark, [tx(), tx(kafka_timestamp=ARRIVED.replace(second=59)), tx(kafka_timestamp=ARRIVED.replace(minute=1))])
    found = monitor.throughput(rows).orderBy("window_start").collect()
    assert [r.transactions for r in found] == [2, 1]


def test_latency(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = score_rules(engineer_features(frame(spark, [tx()]))).withColumn(
        "kafka_timestamp", F.current_timestamp() - F.expr("INTERVAL 10 SECONDS")
    )
    rows.write.parquet(path)
    found = monitor.latency(spark, path).first()
    assert found.transactions == 1 and 8 < found.p50 <= found.max < 60


LAG = {
    "id": "q",
    "name": "alerts",
    "batchId": 3,
    "timestamp": "2024-03-10T08:00:00.000Z",
    "sources": [
        {"description": "Kafka", "metrics": {"minOffsetsBehindLatest": "1", "avgOffsetsBehindLatest": "2.5", "maxOffsetsBehindLatest": "4"}},
        {"description": "files", "metrics": {}},
    ],
}


def test_lag_records(spark, tmp_path):
    listener = monitor.LagListener(spark, str(tmp_path / "lag"))
    listener.record(LAG)
    listener.record({**LAG, "sources": []})
    assert not (tmp_path / "lag").exists()  # waits for more
    listener.onQueryTerminated(None)
    (row,) = spark.read.schema(monitor.LagListener.COLUMNS).json(str(tmp_path / "lag")).collect()
    assert (row.query, row.batch_id, row.min_behind, row.avg_behind, row.max_behind) == ("alerts", 3, 1, 2, 4)


def test_lag_listener_sees_real_progress(spark, tmp_path):
    seen = []

    class Spy(monitor.LagListener):
        def record(self, progress):
            seen.append(progress)
            super().record(progress)

    listener = Spy(spark, str(tmp_path / "lag"))
    spark.streams.addListener(listener)
    try:
        send(spark, tmp_path / "in", batch_of(0, 2))
        run_job(spark, JobConfig(str(tmp_path / "o"), source_of(tmp_path / "in"), sinks=FILES, available_now=True))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert seen and "sources" in seen[0]


def test_kafka_options():
    assert kafka.stream_options("b:1") == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "transactions",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(kafka.MAX_PER_TRIGGER),
    }
    replay = kafka.replay_options(servers="b:1", topic="t", min_partitions=64)
    assert (replay["startingOffsets"], replay["endingOffsets"], replay["minPartitions"]) == ("earliest", "latest", "64")
    assert kafka.stream_options("b:1", min_partitions=9)["minPartitions"] == "9"
    assert kafka.publish_options("b:1")["kafka.acks"] == "all"
    assert kafka.publish_options("b:1")["kafka.retries"] == "3"
    assert kafka.publish_options("b:1")["kafka.max.in.flight.requests.per.connection"] == "1"


class FakeReader:
    """Notes what a reader or writer is told, in place of the absent connector."""

    def __init__(self):
        self.told = {}

    def format(self, kind):
        self.told["format"] = kind
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return self.told


def test_kafka_readers_use_the_connector():
    class FakeSession:
        read = FakeReader()
        readStream = FakeReader()

    for reader, options in ((read_batch, kafka.replay_options("b:1")), (read_stream, kafka.stream_options("b:1", topic="x"))):
        assert reader(FakeSession, options) == {"format": "kafka", **options}


def test_publish_value_is_plain_json(spark):
    value = frame(spark, [tx(merchant=None)]).select(kafka.json_value(frame(spark, [tx()]))).first().value
    assert bytes(value).decode() == (
        '{"transaction_id":"t1","user_id":1001,"amount":50.0,"timestamp":"2024-03-06T12:00:00",'
        '"location":"Denver","is_fraud":0}'
    )


def outputs(spark, base):
    return [rows_of(reader(spark, f"{base}/{name}")) for name, reader in zip(FILES, (read_predictions, read_results, read_alerts), strict=True)]


@pytest.mark.parametrize("first", [True, False])
def test_a_base_serves_one_mode_and_keeps_its_rows(spark, tmp_path, first):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0))
    run_job(spark, JobConfig(base, source_of(inbox), fan_out=first, sinks=FILES, available_now=True))
    before = outputs(spark, base)
    send(spark, inbox, batch_of(20, 5))
    with pytest.raises(ValueError, match="another base"):
        run_job(spark, JobConfig(base, source_of(inbox), fan_out=not first, sinks=FILES, available_now=True))
    assert outputs(spark, base) == before and len(before[0]) == 20


def test_a_new_checkpoint_keeps_what_was_written(spark, tmp_path):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0))
    run_job(spark, JobConfig(base, source_of(inbox), sinks=FILES, available_now=True))
    send(spark, tmp_path / "other", batch_of(20, 5))
    (tmp_path / "out" / "checkpoints").rename(tmp_path / "lost")
    run_job(spark, JobConfig(base, source_of(tmp_path / "other"), sinks=FILES, available_now=True))
    assert read_predictions(spark, f"{base}/predictions").count() == 25
    assert read_results(spark, f"{base}/results").count() == 25
    assert len(list((tmp_path / "out" / "predictions").glob("run=*"))) == 2


def test_a_separate_sink_refuses_the_folder_of_another_checkpoint(spark, tmp_path):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0))
    config = JobConfig(base, source_of(inbox), fan_out=False, sinks=("predictions",), available_now=True)
    run_job(spark, config)
    (tmp_path / "out" / "checkpoints").rename(tmp_path / "lost")
    with pytest.raises(ValueError, match="another checkpoint"):
        run_job(spark, config)
    assert read_predictions(spark, f"{base}/predictions").count() == 20


def test_alerts_are_written_before_results(spark, tmp_path, monkeypatch):
    from amberline.streaming import fanout

    order = []
    for name in ("alerts_view", "results_view"):
        view = getattr(fanout, name)
        monkeypatch.setattr(fanout, name, lambda rows, name=name, view=view: (order.append(name), view(rows))[1])
    fanout.write_batch(score_rules(engineer_features(frame(spark, batch_of(0, 3)))), 0, str(tmp_path), FILES)
    assert order == ["alerts_view", "results_view"]
    assert JobConfig("b", {}).every == "5 seconds"


def test_a_deduplicated_stream_parses_once(spark, tmp_path):
    from amberline.streaming.run import scored_stream

    inbox = tmp_path / "in"
    send(spark, inbox, batch_of(0, 3))
    config = JobConfig(str(tmp_path / "o"), source_of(inbox), dedup_within="1 hour")
    query = scored_stream(spark, config).where("amount > 1").writeStream.format("noop").trigger(availableNow=True)
    query = query.option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("from_json(") == 1


def test_quarantine_query(spark, tmp_path):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    send(spark, inbox, batch_of(0, 3), extra=["not json", ""])
    run_job(spark, JobConfig(base, source_of(inbox), sinks=FILES, available_now=True, quarantine=True))
    kept = spark.read.schema("value string, reason string").json(f"{base}/quarantine").select("value", "reason")
    assert sorted(map(tuple, kept.collect())) == [("", "empty"), ("not json", "not_json")]


def test_sketches_of_waits_merge_within_their_bound(spark):
    rows = spark.range(40_000).selectExpr("ARRIVED - make_dt_interval(0, 0, 0, pmod(id * 7919, 40000) / 100) AS arrival".replace("ARRIVED", "TIMESTAMP '2024-03-10 08:00:00'"), "TIMESTAMP '2024-03-10 08:00:00' AS written", "id % 5 AS part")
    parts = [monitor.wait_sketches(rows.where(f"part = {part}")) for part in range(5)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    whole = monitor.waits_over_time(monitor.wait_sketches(rows), "1 hour").first()
    found = monitor.waits_over_time(together, "1 hour").first()
    assert found.transactions == 40_000 and found.max == 399.99
    for row in (whole, found):  # the k-th smallest wait is k / 100 seconds, so seconds are ranks
        for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs(row[name] / 400 - share) < 0.011
    assert monitor.waits_over_time(monitor.wait_sketches(rows.where("false"))).count() == 0


def test_waits_are_kept_with_the_batches(spark, tmp_path):
    base = str(tmp_path / "out")
    for k in range(2):
        send(spark, tmp_path / "in", batch_of(20 * k))
    run_job(spark, JobConfig(base, source_of(tmp_path / "in", maxFilesPerTrigger="1"), sinks=("predictions",), available_now=True))
    found = state.waits(state.read_state(spark, base), "1000 days").first()
    exact = monitor.latency(spark, f"{base}/predictions").first()
    assert found.transactions == 40 and found.max == exact.max and found.p50 == exact.p50
    assert compact_state(spark, base, keep=0)
    assert state.waits(state.read_state(spark, base), "1000 days").first() == found


OFFSETS = {"id": "q", "batchId": 1, "timestamp": "t"}


def test_lag_from_offsets_of_any_source(spark):
    def lag(start, end, latest):
        return [(r["taken"], r["behind"]) for r in monitor.offset_lag({**OFFSETS, "sources": [{"description": "s", "startOffset": start, "endOffset": end, "latestOffset": latest}]})]

    topic = {"topic": {"0": 5, "1": 7}}
    assert lag(topic, {"topic": {"0": 6, "1": 9}}, {"topic": {"0": 10, "1": 9, "2": 3}}) == [(3, 7)]
    assert lag(None, 4, 9) == [(4, 5)] and lag("3", "4", "9") == [(1, 5)]
    assert lag({"logOffset": 1}, {"logOffset": 2}, None) == [] and lag(topic, topic, "no json") == []
    assert lag(5, 9, 7) == [(4, 0)]


def test_backlog_of_message_files(spark, tmp_path):
    inbox, base = tmp_path / "in it", str(tmp_path / "out")
    checkpoint = f"{base}/checkpoints/fan_out"

    def backlog():
        return monitor.file_backlog(spark, str(inbox), checkpoint).first()

    for k in range(3):
        send(spark, inbox, batch_of(10 * k, 10))
    files = list(inbox.glob("*.parquet"))
    assert (backlog().files, backlog().bytes) == (3, sum(f.stat().st_size for f in files))
    config = JobConfig(base, source_of(inbox, maxFilesPerTrigger="1"), sinks=("predictions",), available_now=True)
    run_job(spark, config)
    assert tuple(backlog()) == (0, 0, None)
    for k in range(3, 5):
        send(spark, inbox, batch_of(10 * k, 10))
    assert backlog().files == 2 and backlog().oldest is not None
    # A batch that was planned but not committed still waits.
    run_job(spark, config)
    newest = max((tmp_path / "out" / "checkpoints" / "fan_out" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.unlink()
    assert backlog().files == 1


def test_repeats_days_apart_are_dropped_and_nothing_else(spark, tmp_path):
    base = str(tmp_path / "out")
    config = JobConfig(base, source_of(tmp_path / "in"), sinks=("predictions",), available_now=True, dedup_within=ALWAYS)
    counts = []
    for day in range(3):  # each day half of the day before again, rows without an id, and new ones
        later = ARRIVED + timedelta(days=100 * day)
        rows = [{**row, "kafka_timestamp": later} for row in batch_of(10 * day)]
        send(spark, tmp_path / "in", [*rows, tx(transaction_id=None, kafka_timestamp=later), tx(transaction_id=None, kafka_timestamp=later)])
        run_job(spark, config)
        counts.append(read_predictions(spark, f"{base}/predictions").count())
    assert counts == [22, 34, 46]
    rows = read_predictions(spark, f"{base}/predictions").where("transaction_id IS NOT NULL")
    assert rows.count() == rows.select("transaction_id").distinct().count() == 40
    assert rows.groupBy("kafka_timestamp").count().orderBy("kafka_timestamp").collect()[0]["count"] == 20


def test_listener_records_lag_by_offsets(spark, tmp_path):
    listener = monitor.LagListener(spark, str(tmp_path / "lag"))
    listener.record({**LAG, "sources": [{**LAG["sources"][0], "startOffset": 1, "endOffset": 3, "latestOffset": 8}, {"description": "rate", "endOffset": 2, "latestOffset": 2}]})
    listener.flush()
    rows = spark.read.schema(monitor.LagListener.COLUMNS).json(str(tmp_path / "lag")).collect()
    assert {(r.source, r.max_behind, r.taken, r.behind) for r in rows} == {("Kafka", 4, 2, 5), ("rate", None, 2, 0)}
