import pytest

from amberline.__main__ import parser
from amberline.sources.files import read_predictions
from tests.test_streaming import batch_of, send


def run(spark, *words):
    args = parser().parse_args(list(words))
    args.run(spark, args)


def test_stream_report_compact_replay(spark, tmp_path, capsys):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, inbox, batch_of(0, 10))
    run(spark, "stream", "--base", base, "--messages", inbox, "--once", "--lag")
    capsys.readouterr()
    printed = []
    for kind in ("parquet", "csv"):
        run(spark, "report", "--base", base, "--results", kind)
        printed.append(capsys.readouterr().out)
        for word in ("total_transactions", "Legitimate", "$100-500", "FRAUD"):
            assert word in printed[-1]
    assert printed[0] == printed[1]
    assert "total_alerts" in printed[0]
    for _ in range(2):
        run(spark, "compact", "--base", base, "--keep", "0")
    assert "nothing to compact" in capsys.readouterr().out
    run(spark, "report", "--base", base)
    assert capsys.readouterr().out == printed[0]
    run(spark, "report", "--base", base, "--from", "2024-03-11")
    assert "total_transactions | 0" in capsys.readouterr().out
    run(spark, "report", "--base", base, "--from", "2024-03-10", "--to", "2024-03-10")
    assert capsys.readouterr().out == printed[0]
    run(spark, "replay", "--base", base, "--messages", inbox)
    assert read_predictions(spark, f"{base}/replay").count() == 10


def test_waits_in_the_report(spark, tmp_path, capsys):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, inbox, batch_of(0, 10))
    run(spark, "stream", "--base", base, "--messages", inbox, "--once", "--no-console")
    run(spark, "report", "--base", base, "--waits")
    assert "|p95" in capsys.readouterr().out


def test_options_of_the_stream(spark, tmp_path, capfd):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, inbox, batch_of(0, 3), extra=["not json"])
    words = ["stream", "--base", base, "--messages", inbox, "--once", "--sinks", "predictions,alerts,console"]
    run(spark, *words, "--no-console", "--every", "1 second", "--quarantine")
    assert "fraud_probability" not in capfd.readouterr().out
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["alerts", "checkpoints", "commits", "predictions", "quarantine", "state"]
    assert parser().parse_args(["stream", "--base", "b"]).every == "5 seconds"
    with pytest.raises(SystemExit, match="--servers"):
        run(spark, "stream", "--base", base)


def test_unreadable_files_are_named(spark, tmp_path, capsys):
    folder = tmp_path / "out" / "alerts" / "run=x" / "batch_id=0"
    folder.mkdir(parents=True)
    (folder / "broken.json.gz").write_bytes(b"no gzip")
    run(spark, "report", "--base", str(tmp_path / "out"))
    assert "broken.json.gz (7 bytes)" in capsys.readouterr().out


def test_report_before_any_output(spark, tmp_path, capsys):
    run(spark, "report", "--base", str(tmp_path / "none"))
    assert "total_transactions | 0" in capsys.readouterr().out
