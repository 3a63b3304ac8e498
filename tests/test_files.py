import gzip
import os
from urllib.parse import unquote

import pandas as pd
import pytest
from pyspark.sql import functions as F

from amberline.operators.features import engineer_features
from amberline.operators.scoring import score_rules
from amberline.operators.unions import union_all
from amberline.operators.views import alerts_view, console_view, results_view
from amberline.schemas import ALERTS, CONSOLE_COLUMNS, CSV_OPTIONS, RESULTS, SCORED, names
from amberline.session import scratch_path
from amberline.sources.files import HEAD_BLOCK, HEAD_MOST, first_records, read_alerts, read_predictions, read_results, unread_files
from amberline.streaming.compaction import compact, read_compacted
from amberline.streaming.fanout import write_batch
from tests.helpers import ARRIVED, frame, tx

TRICKY = [
    tx(transaction_id="1", merchant='Smith, Jones "and" Co', location="Lagos"),
    tx(transaction_id="2", merchant='café "x",y', amount=6000.0),
    tx(transaction_id="3", merchant=None, amount=None),
    tx(transaction_id="4", merchant="back\\slash", location='"'),
    tx(transaction_id="5", merchant="two  spaces ", amount=0.1),
    tx(transaction_id="6", merchant="first line\nsecond line"),
]


@pytest.fixture(scope="module")
def scored(spark):
    return score_rules(engineer_features(frame(spark, TRICKY))).cache()


def test_views(scored):
    assert console_view(scored).columns == list(CONSOLE_COLUMNS)
    assert results_view(scored).columns == names(RESULTS)
    assert alerts_view(scored).columns == names(ALERTS)
    assert {r.transaction_id for r in alerts_view(scored).collect()} == {"1", "2", "5"}


def test_results_round_trip(spark, scored, tmp_path):
    path = str(tmp_path / "csv")
    results_view(scored).coalesce(1).write.options(**CSV_OPTIONS).csv(path)
    back = read_results(spark, path)
    assert back.dtypes == [(name, kind) for name, kind in RESULTS]
    assert sorted(back.collect(), key=str) == sorted(results_view(scored).collect(), key=str)
    assert back.count() == 6
    (file,) = (tmp_path / "csv").glob("part-*.csv")
    pdf = pd.read_csv(file)
    assert pdf.merchant.fillna("").tolist() == [row["merchant"] or "" for row in TRICKY]


def test_empty_text_comes_back_null(spark, tmp_path):
    rows = score_rules(engineer_features(frame(spark, [tx(merchant="")])))
    results_view(rows).write.options(**CSV_OPTIONS).csv(str(tmp_path / "c"))
    assert read_results(spark, str(tmp_path / "c")).first().merchant is None


def test_unreadable_numbers_and_times_are_null(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    header = ",".join(names(RESULTS))
    (folder / "a.csv").write_text(
        f"{header}\nx,1,12.5,L,M,0.8,1,0,rule_based,2024-03-10T08:00:00.000Z\ny,2,oops,L,M,high,0,0,rule_based,soon\n"
    )
    rows = {r.transaction_id: r for r in read_results(spark, str(folder)).collect()}
    assert (rows["x"].amount, rows["x"].processed_time) == (12.5, ARRIVED)
    assert (rows["y"].amount, rows["y"].fraud_probability, rows["y"].processed_time) == (None, None, None)
    assert rows["y"].is_fraud_predicted == 0


@pytest.mark.parametrize("multiline", [True, False])
def test_files_are_matched_by_column_name(spark, tmp_path, multiline):
    standard = names(RESULTS)
    values = dict(zip(standard, ["?", "1", "5.5", "L", '"amount\nmerchant\n"' if multiline else "M", "0.8", "1", "0", "rule_based", "2024-03-10T08:00:00.000Z"]))

    def write(folder, columns, key, quoted=False):
        where = tmp_path / "all" / folder
        where.mkdir(parents=True, exist_ok=True)
        head = ",".join(f'"{c}"' if quoted else c for c in columns)
        row = ",".join({**values, "transaction_id": key, "note": "x"}[c] for c in columns)
        (where / f"{key}.csv").write_text(f"{head}\n{row}\n")

    write("batch_id=0", standard, "std")
    write("batch_id=0", standard, "quoted", quoted=True)
    write("batch_id=1", standard[::-1], "reversed & 50% so")
    write("batch_id=1", ["amount", "transaction_id"], "short")
    write("batch_id=1", [*standard, "note"], "long")
    (tmp_path / "all" / "batch_id=1" / "broken.csv.gz").write_bytes(b"no gzip")
    found = read_results(spark, str(tmp_path / "all"), partitions=["batch_id"], multiline=multiline)
    rows = {r.transaction_id: r for r in found.collect()}
    assert set(rows) == {"std", "quoted", "reversed & 50% so", "short", "long"} and found.count() == 5
    for column in names(RESULTS):
        assert len(found.select(column).collect()) == 5, column
    assert found.where("amount > 5").count() == 5 and found.where("location = 'L'").count() == 4
    full = {"std", "quoted", "reversed & 50% so", "long"}
    assert {tuple(rows[key])[1:10] for key in full} == {tuple(rows["std"])[1:10]}
    assert rows["std"].merchant == ("amount\nmerchant\n" if multiline else "M")
    assert rows["reversed & 50% so"].processed_time == ARRIVED
    assert (rows["short"].amount, rows["short"].location, rows["short"].batch_id) == (5.5, None, 1)
    assert read_results(spark, str(tmp_path / "all"), nested=True).count() == 5


def test_nested_folders_and_partitions(spark, scored, tmp_path):
    write_batch(scored, 0, str(tmp_path))
    write_batch(scored, 1, str(tmp_path))
    assert read_results(spark, str(tmp_path / "results")).count() == 12
    assert read_results(spark, str(tmp_path / "results"), nested=True).count() == 12
    kept = read_alerts(spark, str(tmp_path / "alerts"), partitions=["batch_id"])
    assert kept.columns == [*names(ALERTS), "batch_id"]
    assert kept.where("batch_id = 1").count() == 3


def test_missing_folders_are_empty(spark, tmp_path):
    for reader, layout in ((read_results, RESULTS), (read_alerts, ALERTS), (read_predictions, SCORED)):
        empty = reader(spark, str(tmp_path / "none"))
        assert empty.columns == names(layout) and empty.count() == 0


def test_bad_alert_line_drops_only_itself(spark, tmp_path):
    folder = tmp_path / "a" / "deep"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text(
        '{"transaction_id":"1","amount":5.5,"alert_time":"2024-03-10T08:00:00.000Z"}\n'
        '{"transaction_id":"2","amou\n'
        "\n"
        '{"transaction_id":"3","amount":"many"}\n'
    )
    alerts = read_alerts(spark, str(tmp_path / "a"), nested=True)
    assert alerts.count() == 2
    rows = {r.transaction_id: r for r in alerts.collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["1"].amount, rows["1"].alert_time, rows["1"].location) == (5.5, ARRIVED, None)
    assert rows["3"].amount is None
    assert alerts.where("amount > 5").count() == 1


def test_damaged_predictions_are_an_error(spark, scored, tmp_path):
    write_batch(scored.coalesce(1), 0, str(tmp_path))
    write_batch(scored.coalesce(1), 1, str(tmp_path))
    (file,) = (tmp_path / "predictions" / "run=none" / "batch_id=0").glob("*.parquet")
    file.write_bytes(file.read_bytes()[:-200])
    with pytest.raises(Exception, match="(?i)parquet"):  # noqa: PT011
        read_predictions(spark, str(tmp_path / "predictions")).collect()
    with pytest.raises(Exception, match="(?i)parquet"):  # noqa: PT011
        compact(spark, str(tmp_path), keep=0)
    assert read_compacted(spark, str(tmp_path), "alerts").count() == 6


def test_headers_of_any_names_are_read(spark, tmp_path):
    standard = names(RESULTS)
    folder = tmp_path / "all"
    folder.mkdir()
    row = {"transaction_id": "?", "merchant": "Merchant_amount_location_services", "location": "amount", "amount": "2.5"}

    def write(key, columns):
        values = [{**row, "transaction_id": key}.get(c, "x" if c not in standard else "") for c in columns]
        (folder / f"{key}.csv").write_text(f"{','.join(columns)}\n{','.join(values)}\n")

    write("standard", standard)
    write("space", [*standard, "batch no"])
    write("dash", ["risk-score", *standard])
    write("digit", [*standard[:3], "1st_amount", *standard[3:]])
    write("comma", ['"a,b"', *standard])
    write("few", ["merchant", "location"])
    (folder / "empty.csv").write_text("")
    (folder / "header_only.csv").write_text("x y,z\n")
    rows = read_results(spark, str(folder)).collect()
    assert sorted(r.transaction_id or "" for r in rows) == ["", "comma", "dash", "digit", "space", "standard"]
    assert {(r.merchant, r.location) for r in rows} == {(row["merchant"], row["location"])}
    assert sum(r.amount == 2.5 for r in rows) == 5


def test_skipped_results_are_logged_and_listed(spark, scored, tmp_path, caplog):
    path = str(tmp_path / "csv")
    results_view(scored).write.options(**CSV_OPTIONS).csv(path)
    (tmp_path / "csv" / "broken.csv.gz").write_bytes(b"no gzip")
    assert read_results(spark, path).count() == 6
    assert "1 unreadable files" in caplog.text
    assert [r.length for r in unread_files(spark, path).collect()] == [7]
    assert unread_files(spark, str(tmp_path / "none")).count() == 0


def test_union_fills_missing_columns(spark):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    right = spark.createDataFrame([(2.0, "b")], "y double, k string")
    assert sorted(map(tuple, union_all([left, right]).collect())) == [("a", 1, None), ("b", None, 2.0)]


def everything(spark, base, **dates):
    return {name: sorted(map(str, read_compacted(spark, base, name, **dates).collect())) for name in ("predictions", "alerts")}


def test_compaction_keeps_rows_and_prunes(spark, scored, tmp_path):
    base = str(tmp_path)
    for batch in range(3):
        write_batch(scored, batch, base)
    before = everything(spark, base)
    assert len(before["predictions"]) == 18 and len(before["alerts"]) == 9
    for name in before:
        assert compact(spark, base, name)  # leaves the newest batch
        assert compact(spark, base, name) is None
    assert everything(spark, base) == before
    write_batch(scored, 3, base)
    assert compact(spark, base, "predictions") and not compact(spark, base, "predictions")
    assert read_compacted(spark, base).count() == 24
    assert read_compacted(spark, base, since="2024-03-11").count() == 0
    day = read_compacted(spark, base, since="2024-03-10", until="2024-03-10")
    assert day.count() == 24
    filters = day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1:]
    assert any("arrival_date" in part for part in filters) and any("batch_id" in part for part in filters)


def test_chunk_without_a_mark_is_not_read(spark, scored, tmp_path, monkeypatch):
    base = str(tmp_path)
    for batch in range(2):
        write_batch(scored, batch, base)
    before = everything(spark, base)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost on purpose")))
    with pytest.raises(RuntimeError, match="lost on purpose"):
        compact(spark, base)
    monkeypatch.undo()
    assert everything(spark, base) == before
    assert compact(spark, base) and everything(spark, base) == before


def test_missing_folders_have_their_partition_columns(spark, tmp_path):
    empty = read_predictions(spark, str(tmp_path / "none"), partitions=["run", "batch_id"])
    assert empty.columns[-2:] == ["run", "batch_id"] and empty.where("batch_id BETWEEN 0 AND 9").count() == 0
    assert compact(spark, str(tmp_path / "none")) is None
    assert read_compacted(spark, str(tmp_path / "none"), "alerts", since="2024-01-01").count() == 0


def test_scratch_is_under_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(root) and first != second


def test_scratch_without_a_setting_is_in_the_warehouse(spark):
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=""):
                return {"spark.sql.warehouse.dir": "file:/wh/"}.get(name, default)

    assert scratch_path(Session, "x").startswith("file:/wh/_scratch/x-")


def test_headers_take_a_block_of_each_file(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    line = "t1,1,5.0,Denver,Acme,0.1,0,0,rule_based,2024-03-10T08:00:00.000Z\n"
    for i in range(3):
        (folder / f"big {i} & co.csv").write_text(",".join(names(RESULTS)) + "\n" + line * 20_000)
    (folder / "quoted.csv").write_text('"transaction_id","odd\nname","amount"\nq1,x,2.5\n')
    (folder / "marked.csv").write_bytes("\ufefftransaction_id,amount\r\nm1,3.5\r\n".encode())
    (folder / "empty.csv").write_bytes(b"")
    with gzip.open(folder / "zipped.csv.gz", "wt") as packed:
        packed.write(",".join(names(RESULTS)) + "\n" + line)
    (folder / "broken.csv.gz").write_bytes(b"no gzip")
    heads = {os.path.basename(unquote(r.file)): r for r in first_records(spark, str(folder)).collect()}
    assert len(heads) == 7 and all(r.fetched <= HEAD_BLOCK for r in heads.values())
    assert sum(p.stat().st_size for p in folder.iterdir()) > 40 * HEAD_BLOCK
    assert heads["quoted.csv"].header == ["transaction_id", "odd\nname", "amount"] and heads["marked.csv"].header == ["transaction_id", "amount"]
    assert not heads["broken.csv.gz"].readable and heads["zipped.csv.gz"].header == names(RESULTS)
    assert [os.path.basename(r.file) for r in unread_files(spark, str(folder)).collect()] == ["broken.csv.gz"]
    rows = {r.transaction_id: r["n"] for r in read_results(spark, str(folder)).groupBy("transaction_id").agg(F.count("*").alias("n")).collect()}
    assert rows == {"t1": 60_001, "q1": 1, "m1": 1}


def test_an_open_quote_does_not_read_the_file(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "odd.csv").write_text('transaction_id,"amount\n' + "x,1\n" * 1_000_000)
    (row,) = first_records(spark, str(tmp_path / "r")).collect()
    assert row.line == 'transaction_id,"amount' and row.fetched <= HEAD_MOST + HEAD_BLOCK < row.length


def test_stores_that_tasks_cannot_open(spark, tmp_path):
    scored_csv = tmp_path / "r"
    scored_csv.mkdir()
    (scored_csv / "a.csv").write_text("amount,transaction_id\n2.5,a1\n")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.heads.link./in", f"file://{scored_csv}")
    (row,) = first_records(spark, "viewfs://heads/in").collect()
    assert (row.line, row.header, row.readable) == ("amount,transaction_id", ["amount", "transaction_id"], True)
    assert [(r.transaction_id, r.amount) for r in read_results(spark, "viewfs://heads/in").collect()] == [("a1", 2.5)]
