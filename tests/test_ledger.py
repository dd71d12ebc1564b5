"""Batches committed one by one, and read-back of what a write added."""

import pytest
from pyspark.sql import functions as F

from lakeops.sources import lake, ledger

BATCH = ["day", "no"]


def rows(spark, bad=()):
    data = [(f"d{i % 2}", i // 10, i, "bad" if i in bad else None) for i in range(60)]
    return spark.createDataFrame(data, "day string, no int, id int, flaw string").repartition(3)


def held(spark, path):
    return sorted(r.id for r in ledger.committed_rows(spark, path, BATCH).collect())


def status(spark, path):
    return sorted((r.day, r.no, r.n_rows, r.status, r.error) for r in ledger.read_ledger(spark, path).collect())


def test_bad_batch_leaves_the_others_whole(spark, tmp_path):
    path = str(tmp_path / "l")
    ledger.write_in_batches(rows(spark, {13, 17}), BATCH, path, F.col("flaw"))
    lost = {i for i in range(60) if i % 2 and i // 10 == 1}
    assert held(spark, path) == [i for i in range(60) if i not in lost]
    assert [s for s in status(spark, path) if s[3] != ledger.COMMITTED] == [("d1", 1, 5, ledger.ROLLED_BACK, "bad")]
    assert ledger.audit(spark, path, BATCH).count() == 0
    # A restart takes up the rolled-back batch only, a further one adds nothing.
    again = ledger.write_in_batches(rows(spark), BATCH, path, F.col("flaw"))
    assert ledger.read_ledger(spark, path).where(F.col("run") == again).count() == 1
    assert held(spark, path) == list(range(60))
    last = ledger.write_in_batches(rows(spark), BATCH, path, F.col("flaw"))
    assert ledger.read_ledger(spark, path).where(F.col("run") == last).count() == 0
    assert held(spark, path) == list(range(60)) and len(status(spark, path)) == 13


def test_a_run_that_died_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "l")
    with pytest.raises(FileNotFoundError):
        ledger.committed_rows(spark, path, BATCH)
    first = ledger.stage(rows(spark), BATCH, path)
    assert ledger.read_ledger(spark, path) is None
    ledger.write_in_batches(rows(spark), BATCH, path)
    assert held(spark, path) == list(range(60))
    assert ledger.discard_unfinished(spark, path) == [first] and ledger.discard_unfinished(spark, path) == []
    assert held(spark, path) == list(range(60))


def test_null_batches_and_audit(spark, tmp_path):
    path = str(tmp_path / "l")
    data = spark.createDataFrame([(None, 1, 1), (None, 1, 2), ("a", None, 3)], "day string, no int, id int")
    for _ in range(2):
        ledger.write_in_batches(data, BATCH, path)
        assert held(spark, path) == [1, 2, 3]
    run = ledger.read_ledger(spark, path).where("n_rows > 0").first().run
    data.withColumn("_batch_error", F.lit(None).cast("string")).limit(1).write.mode("append").parquet(f"{path}/staged/_batch_run={run}")
    assert ledger.audit(spark, path, BATCH).count() == 1
    with pytest.raises(ValueError):
        ledger.stage(data, [], path)


def test_only_added_files_are_read(spark, tmp_path):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS added")
    table = "added.t"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    lake.create_table(spark, table, "id INT, day STRING", ["day"], str(tmp_path / "t"))
    part = lambda lo, hi: spark.range(lo, hi).select(F.col("id").cast("int"), (F.col("id") % 3).cast("string").alias("day"))
    lake.append(part(0, 300), table)
    old = set(spark.table(table).inputFiles())
    added = lake.append_files(part(300, 330), table)
    back = lake.read_files(spark, table, added)
    assert not old & set(back.inputFiles()) and len(back.inputFiles()) == len(added)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in part(300, 330).collect())
    assert {(r.day, r.record_count > 0) for r in lake.file_inventory(back, ["day"]).collect()} == {(d, True) for d in "012"}
    assert lake.read_files(spark, table, []).count() == 0
    check = lake.copy_to_lake(part(330, 340), table, partition_by=["day"])
    assert tuple(check.first()) == (10, 10, True)
    assert not old & set(check.inputFiles())
    assert tuple(lake.copy_to_lake(part(0, 5), table, partition_by=["day"], replace_partitions=True).first()) == (5, 5, True)
    assert spark.table(table).count() == 5
    spark.sql("DROP NAMESPACE added CASCADE")
