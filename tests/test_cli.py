"""The command-line jobs, run in-process on the test session."""

import datetime as dt

import pytest

from lakeops.cli import main
from lakeops.sources import files


def test_replace_long(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    files.write_csv(spark.createDataFrame([("a" * 101, "x"), ("ok", "y")], "c string, d string"), src)
    main(["replace-long", src, out, "c"], spark)
    assert sorted(tuple(r) for r in files.read_csv_text(spark, out).collect()) == [("0", "x"), ("ok", "y")]
    with pytest.raises(ValueError):
        main(["replace-long", src, str(tmp_path / "o2"), "missing"], spark)


def test_shift_decode(spark, tmp_path):
    (tmp_path / "in.txt").write_text("Khoor Zruog\nDEF\n")
    main(["shift-decode", str(tmp_path / "in.txt"), str(tmp_path / "out")], spark)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["ABC", "Hello World"]


def test_run_summary(spark, tmp_path, capsys):
    rows = [(f"nightly_{k}", f"2031-0{m}-11 07:{k}0", "Failed" if (m + k) % 2 else "Success") for k in range(3) for m in range(1, 9)]
    spark.createDataFrame(rows, "job_name string, date string, status string").write.parquet(str(tmp_path / "runs"))
    main(["run-summary", str(tmp_path / "runs"), "--search", "NIGHTLY_2"], spark)
    out = capsys.readouterr().out
    assert "nightly_2" in out and "2031-08-11 07:20" in out and "nightly_1" not in out


def test_parse_report(spark, tmp_path):
    (tmp_path / "r1.txt").write_text("Start Part 1\nAAA | 1 | Buy | ok\nEnd Part 1\nStart Part 2\nR | high | hedge\n")
    main(["parse-report", str(tmp_path / "r1.txt"), str(tmp_path / "out")], spark)
    got = sorted((r.part, r.c1) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, "AAA"), (2, "R")]


def test_positions(spark, tmp_path, capsys):
    df = spark.createDataFrame([("AAA", "10", "1.005", "100.5"), ("BBB", "5", None, "300.25")],
                               "symbol string, position string, markPrice string, positionValue string")
    files.write_positions_xml(df, str(tmp_path / "xml"))
    main(["positions", str(tmp_path / "xml")], spark)
    out = capsys.readouterr().out
    assert out.index("BBB") < out.index("AAA") and "300.25" in out


def test_key_job(spark, tmp_path, capsys):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    keys = spark.createDataFrame([(d1, 1), (d1, 2), (d2, 3), (d2, 4), (d2, 5)], "businessdate date, id long")
    payload = spark.createDataFrame([
        (d1, 1, "1,2,3", "1,1,1", "0,0,1"),     # (1+1)-0, (2+1)-0, (3+1)-1 -> 2,3,3: sum 8, max 3
        (d1, 1, "9,9,9", "9,9,9", "9,9,9"),     # second row of the same key: one of the two is used
        (d2, 3, "1,x,3", "1,1,1", "1,1,1"),     # bad element: zero vector -> 0,0,0 -> sum 0
        (d2, 4, "1,2", "1,1,1", "0,0,0"),       # wrong length: error
        (d2, 5, "5,5,5", "0,0,0", "1,1,1"),     # -> 4,4,4 -> sum 12
    ], "businessdate date, id long, b1 string, b2 string, b3 string")
    keys.write.parquet(str(tmp_path / "keys"))
    payload.write.parquet(str(tmp_path / "payload"))
    main(["key-job", "--keys", str(tmp_path / "keys"), "--payload", str(tmp_path / "payload"),
          "--vectors", "b1,b2,b3", "--n", "3", "--added", "2", "--output", str(tmp_path / "out")], spark)
    res = {r.id: (r.status, r.result_sum, r.result_max) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert res[1] in (("Success", 8.0, 3.0), ("Success", 27.0, 9.0)) and res[2] == ("No data", None, None)
    assert res[3] == ("Success", 0.0, 0.0) and res[5] == ("Success", 12.0, 4.0)
    assert res[4][0] == "Error: expected 3 values in column 1, found 2"
    out = capsys.readouterr().out
    assert "|2      |5        |3                |1      |1     |" in out  # dates, ids, processed, no data, errors


def test_hierarchy_job(spark, tmp_path):
    lines = [
        '{"box": "TOP", "jobs": [{"name": "B1", "type": "BOX", "runNum": 1}, {"name": "J1", "type": "CMD"}]}',
        '{"box": "B1", "jobs": [{"name": "J2", "type": "cmd", "status": "4"}, {"name": "TOP", "type": "box"}]}',
        '{"box": "J1", "jobs": [{"name": "NEVER", "type": "CMD"}]}',
    ]
    (tmp_path / "jobs.json").write_text("\n".join(lines) + "\n")
    main(["hierarchy", str(tmp_path / "jobs.json"), str(tmp_path / "out"), "--root", "TOP"], spark)
    got = {(r.name, r.type, r.runNum, r.status, r.depth) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("B1", "BOX", 1, "N/A", 1), ("J1", "CMD", 0, "N/A", 1), ("J2", "cmd", 0, "4", 2),
                   ("TOP", "box", 0, "N/A", 2)}
