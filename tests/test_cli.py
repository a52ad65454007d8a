"""Command line entry (runs in the test session)."""

from conftest import SF0001
from ledgerlens.__main__ import main


def test_cli_query_and_questions(spark, capsys, tmp_path):
    main(["--tables", SF0001, "--query", "row_count"])
    out = capsys.readouterr().out
    assert "== row_count" in out and "6000" in out
    main(["--tables", SF0001, "--questions", "--rows", "1", "--out", str(tmp_path / "q")])
    out = capsys.readouterr().out
    assert out.count("written to") == 8
    assert spark.read.parquet(str(tmp_path / "q" / "q7_yoy_growth")).count() > 0
