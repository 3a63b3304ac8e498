"""Batches as a whole: the split of a batch, states that add up, and readers that see complete batches only."""

from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from amberline.operators import report
from amberline.operators.features import engineer_features
from amberline.operators.quality import judge_transactions, quarantine
from amberline.operators.scoring import score_rules
from amberline.sources.files import read_predictions
from amberline.sources.kafka import read_batch
from amberline.streaming import commits, fanout, state
from amberline.streaming.compaction import batches_of, compact, compact_state, read_compacted, reclaim, take_snapshot
from amberline.streaming.fanout import write_batch
from amberline.streaming.run import JobConfig, run_job
from tests.helpers import ARRIVED, frame, tx
from tests.test_streaming import FILES, batch_of, rows_of, send, source_of

BAD = ["not json", "", None, '{"amount": "many", "user_id": 3}', '{"other": 1}', "[]"]


def refused_by_batch(spark, base):
    kept = spark.read.schema("value string, reason string, run string, batch_id int").json(f"{base}/quarantine")
    return {r.batch_id: r["count"] for r in kept.groupBy("batch_id").count().collect()}


def scored_by_batch(spark, base):
    rows = read_predictions(spark, f"{base}/predictions", partitions=["run", "batch_id"])
    return {r.batch_id: r["count"] for r in rows.groupBy("batch_id").count().collect()}


def states_by_batch(spark, base):
    rows = spark.read.schema(f"{state.STATE}, run string, batch_id int").parquet(f"{base}/state").where("kind IN ('messages', 'refused')")
    return {(r.batch_id, r.kind): r.n for r in rows.collect()}


@pytest.mark.parametrize("fails_at", [None, "alerts_view", "results_view", "batch_state"])
@pytest.mark.parametrize("dedup", [None, "1 hour"])
def test_every_message_is_scored_or_refused_once(spark, tmp_path, monkeypatch, fails_at, dedup):
    inbox, base = tmp_path / "in", str(tmp_path / "out")
    for k in range(3):
        send(spark, inbox, batch_of(20 * k, 20), extra=BAD[: 2 * k + 1])
    config = JobConfig(base, source_of(inbox, maxFilesPerTrigger="1"), sinks=FILES, available_now=True, quarantine=True, dedup_within=dedup)
    if fails_at:
        seen = []

        def broken(rows, view=getattr(fanout, fails_at)):
            seen.append(1)
            if len(seen) == 2:
                raise RuntimeError("halfway")
            return view(rows)

        monkeypatch.setattr(fanout, fails_at, broken)
        with pytest.raises(StreamingQueryException):
            run_job(spark, config)
        (last,) = commits.committed(spark, base).values()
        assert last == 0 and read_compacted(spark, base).count() == 20
    run_job(spark, config)
    messages = read_batch(spark, source_of(inbox))
    scored, refused, counts = scored_by_batch(spark, base), refused_by_batch(spark, base), states_by_batch(spark, base)
    given = {batch: 20 + 2 * k + 1 for batch, k in zip(sorted(scored), sorted(range(3), key=lambda k: refused[k]), strict=True)}
    assert len(scored) == 3 and sum(given.values()) == messages.count()
    for batch in scored:
        assert scored[batch] + refused[batch] == counts[batch, "messages"] and refused[batch] == counts[batch, "refused"]
    sound = judge_transactions(messages).where("_reason IS NULL").drop("_body", "_reason")
    columns = read_predictions(spark, f"{base}/predictions").columns
    assert rows_of(read_predictions(spark, f"{base}/predictions")) == rows_of(score_rules(engineer_features(sound)).select(*columns))
    kept = spark.read.schema("value string, reason string").json(f"{base}/quarantine").select("value", "reason")
    assert rows_of(kept) == rows_of(quarantine(messages).select("value", "reason"))
    figures = state.intake(take_snapshot(spark, base).state()).first()
    assert (figures.messages, figures.refused) == (messages.count(), quarantine(messages).count())


def test_the_split_decodes_once(spark, tmp_path):
    messages = spark.createDataFrame([("{}", ARRIVED), ("x", ARRIVED)], "value string, timestamp timestamp")
    judged = judge_transactions(messages)
    plan = judged.where("_reason IS NULL AND amount > 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") + plan.count("JsonToStructs") == 1


def scored_rows(spark):
    rows = [tx(transaction_id=f"{i}", amount=[None, float("nan"), -3.0, 0.125 * i, 7000.5][i % 5], location=[None, "Lagos", "Denver", f"Town {i % 13}"][i % 4], is_fraud=[0, 1, None][i % 3]) for i in range(200)]
    return score_rules(engineer_features(frame(spark, rows)))


def same(left, right):
    assert left.columns == right.columns and left.dtypes == right.dtypes
    assert list(map(str, left.collect())) == list(map(str, right.collect()))


def compare(spark, base, rows):
    merged = take_snapshot(spark, base).state()
    for name in ("summary", "class_split", "top_locations"):
        same(getattr(state, name)(merged), getattr(report, name)(rows))
    same(state.amount_buckets(merged).orderBy("bucket_no"), report.amount_buckets(rows).orderBy("bucket_no"))


def test_states_give_the_report(spark, tmp_path):
    base, rows = str(tmp_path), scored_rows(spark)
    for batch in range(4):
        write_batch(rows.where(F.col("transaction_id").cast("int") % 4 == batch), batch, base, ("predictions",))
    compare(spark, base, rows)
    assert compact_state(spark, base, keep=2) and compact_state(spark, base, keep=2) is None
    compare(spark, base, rows)
    write_batch(rows.where("transaction_id = '3'"), 4, base, ("predictions",))
    assert compact_state(spark, base, keep=1)
    compare(spark, base, rows.unionByName(rows.where("transaction_id = '3'")))
    files = take_snapshot(spark, base).state().inputFiles()
    assert files and not any("/predictions" in f for f in files)
    plan = take_snapshot(spark, base).state()._jdf.queryExecution().executedPlan().toString()
    assert any("batch_id" in line for line in plan.splitlines() if "PartitionFilters" in line)


def test_states_of_no_rows(spark, tmp_path):
    base, rows = str(tmp_path), scored_rows(spark).limit(0)
    assert take_snapshot(spark, base).state() is None
    write_batch(rows, 0, base, ("predictions",))
    compare(spark, base, rows)


def outputs(snapshot):
    return rows_of(snapshot.rows("predictions")), rows_of(snapshot.rows("alerts")), rows_of(snapshot.results()), rows_of(state.summary(snapshot.state()))


@pytest.mark.parametrize("fails_at", ["alerts_view", "results_view", "batch_state"])
def test_no_reader_sees_part_of_a_batch(spark, tmp_path, monkeypatch, fails_at):
    base, rows = str(tmp_path), scored_rows(spark)
    write_batch(rows.where("amount > 10"), 0, base)
    before = outputs(take_snapshot(spark, base))
    view = getattr(fanout, fails_at)
    seen = []

    def broken(written):
        seen.append(outputs(take_snapshot(spark, base)))
        raise RuntimeError("between two writes")

    monkeypatch.setattr(fanout, fails_at, broken)
    with pytest.raises(RuntimeError):
        write_batch(rows.where("amount < 10"), 1, base)
    assert seen == [before] and outputs(take_snapshot(spark, base)) == before
    assert compact(spark, base, "predictions", keep=0) and outputs(take_snapshot(spark, base)) == before
    monkeypatch.setattr(fanout, fails_at, view)
    write_batch(rows.where("amount < 10"), 1, base)
    after = outputs(take_snapshot(spark, base))
    assert len(after[0]) == rows.where("amount > 10 OR amount < 10").count()


def test_a_snapshot_stays_as_it_is(spark, tmp_path):
    base, rows = str(tmp_path), scored_rows(spark)
    for batch in range(3):
        write_batch(rows.where(F.col("transaction_id").cast("int") % 8 == batch), batch, base)
    snapshot = take_snapshot(spark, base)
    before = outputs(snapshot)
    write_batch(rows.where("transaction_id = '7'"), 3, base)
    for name in ("predictions", "alerts"):
        compact(spark, base, name, keep=0)
    compact_state(spark, base, keep=0)
    assert outputs(snapshot) == before
    assert len(outputs(take_snapshot(spark, base))[0]) == len(before[0]) + 1


def test_a_complete_batch_is_not_written_again(spark, tmp_path):
    base, rows = str(tmp_path), scored_rows(spark)
    write_batch(rows, 0, base, ("predictions",))
    files = sorted(p.name for p in (tmp_path / "predictions").rglob("*.parquet"))
    write_batch(rows, 0, base, ("predictions",))
    assert sorted(p.name for p in (tmp_path / "predictions").rglob("*.parquet")) == files
    assert commits.committed(spark, base) == {"none": 0} and len(list((tmp_path / "commits").glob("*.json"))) == 1


def test_outputs_of_older_runs_are_complete(spark, tmp_path):
    base, rows = str(tmp_path), scored_rows(spark)
    rows.write.parquet(f"{base}/predictions/run=old/batch_id=7")
    write_batch(rows.limit(5), 0, base, ("predictions",))
    assert read_compacted(spark, base).count() == rows.count() + 5


@pytest.mark.parametrize("keep", [0, 1])
def test_reclaimed_batches_stay_readable(spark, tmp_path, keep):
    base, rows = str(tmp_path), scored_rows(spark)
    for batch in range(4):
        write_batch(rows.where(F.col("transaction_id").cast("int") % 8 == batch), batch, base)
    before = outputs(take_snapshot(spark, base))
    for name in ("predictions", "alerts"):
        assert compact(spark, base, name, keep) and reclaim(spark, base, name) == 0  # readers may still run
        assert len(batches_of(spark, base, name, "none")) == 4
    compact_state(spark, base, keep)
    assert outputs(take_snapshot(spark, base)) == before
    for name in ("predictions", "alerts", "state"):
        assert reclaim(spark, base, name, timedelta(0)) == 4 - keep and reclaim(spark, base, name, timedelta(0)) == 0
        assert batches_of(spark, base, name, "none") == [3][: keep]
    assert outputs(take_snapshot(spark, base)) == before
    write_batch(rows.where("transaction_id = '7'"), 4, base)
    assert len(outputs(take_snapshot(spark, base))[0]) == len(before[0]) + 1
    compare(spark, base, rows.where(F.col("transaction_id").cast("int") % 8 < 4).unionByName(rows.where("transaction_id = '7'")))
    assert reclaim(spark, str(tmp_path / "none")) == 0


def test_a_lookup_by_id_reads_few_row_groups(spark, tmp_path):
    base, rows = str(tmp_path / "out"), scored_rows(spark).drop("transaction_id", "kafka_timestamp")
    many = spark.range(40_000).selectExpr("lpad(cast(hash(id) AS STRING), 12, '0') AS transaction_id", "timestamp_seconds(1700000000 + id % 3 * 86400) AS kafka_timestamp")
    columns = scored_rows(spark).columns
    write_batch(many.crossJoin(F.broadcast(rows.limit(1))).select(*columns), 0, base, ("predictions",))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compact(spark, base, keep=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = many.selectExpr("max(transaction_id)").first()[0]
    holding = 0
    by_day: dict[str, list] = {}
    for file in (tmp_path / "out" / "predictions_daily").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(0).statistics
            by_day.setdefault(file.parent.name, []).append((stats.min, stats.max))
            holding += stats.min <= wanted <= stats.max
    assert sum(map(len, by_day.values())) >= 4 and all(a[1] <= b[0] for ends in by_day.values() for a, b in zip(sorted(ends), sorted(ends)[1:], strict=False))
    found = read_compacted(spark, base).where(F.col("transaction_id") == wanted)
    assert found.count() == 1 and holding <= 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_id" in plan
