"""Checks on physical plans and on the stream/batch equivalence."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakeops.operators.runs import latest_run
from lakeops.plans.derive import run_records
from lakeops.sources import files, jdbc
from lakeops.streaming import status as st
from lakeops.tables import Tables
from tests.conftest import SF_SMALL

QUERIES = entry.queries()


def plan(df, executed=False):
    if executed:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_date_range_reaches_the_scan(spark):
    text = plan(QUERIES["daily_totals"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_point_lookup_is_pushed(spark):
    text = plan(QUERIES["composite_lookup"](spark, SF_SMALL))
    assert "EqualTo(l_orderkey,7)" in text and "EqualTo(l_linenumber,1)" in text


def test_small_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["broadcast_lookup"](spark, SF_SMALL))


def test_hit_ratio_stays_in_the_jvm(spark):
    text = plan(QUERIES["hit_ratio"](spark, SF_SMALL), executed=True)
    assert "Python" not in text and "* HashAggregate" in text


def test_no_cartesian_products(spark):
    for name in ("tenor_grid", "replicate_rows", "even_split", "readback_check"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_first_row_is_a_partial_aggregate(spark):
    text = plan(QUERIES["key_payload_join"](spark, SF_SMALL))
    assert text.count("SortAggregate") >= 2 and "Window" not in text


def test_stream_equals_batch(spark):
    stream_out = QUERIES["stream_latest_status"](spark, SF_SMALL)
    ev = Tables(spark, SF_SMALL).events
    batch = ev.groupBy("user_id").agg(F.max(F.struct("ts", (-F.col("event_id")).alias("s"), "event_type")).alias("l"),
                                      F.count(F.lit(1)).alias("n_events")).select(
        "user_id", F.col("l.ts").alias("latest_ts"), F.col("l.event_type").alias("latest_status"), "n_events")
    assert batch.exceptAll(stream_out).count() == 0 and stream_out.exceptAll(batch).count() == 0
    assert stream_out.count() == latest_run(run_records(ev)).count()


def test_stream_reads_bounded_micro_batches(spark, tmp_path):
    events = Tables(spark, SF_SMALL).events
    landing = str(tmp_path / "landing")
    st.land_files(events.repartition(8), landing)
    seen = []
    stream = st.read_event_stream(spark, landing, events.schema, files_per_trigger=2)
    st.run_available(stream, str(tmp_path / "ckpt"), "bounded_batches", "append",
                     lambda df, i: seen.append(i))
    assert len(seen) == 4


def test_jdbc_options():
    opts = jdbc.jdbc_read_options("jdbc:x", table="t", partition_column="id", lower_bound=0, upper_bound=100,
                                  num_partitions=4)
    assert opts["numPartitions"] == "4" and opts["partitionColumn"] == "id" and opts["dbtable"] == "t"
    assert jdbc.jdbc_read_options("jdbc:x", query="SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.jdbc_read_options("jdbc:x", table="t", query="SELECT 1")
    assert jdbc.jdbc_write_options("jdbc:x", "t")["batchsize"] == "1000"


SORT_SETTINGS = {
    "spark.sql.execution.rangeExchange.sampleSizePerPartition": ("5", "100"),
    "spark.sql.adaptive.coalescePartitions.enabled": ("true", "false"),
    "spark.sql.exchange.reuse": ("true", "false"),
}


@pytest.fixture(params=[0, 1], ids=["few_rows_seen", "no_reuse"])
def odd_sorts(request, spark):
    """Settings under which two sorts of the same rows would not agree on their partitions."""
    extra = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
             "spark.sql.shuffle.partitions": "16"}
    new = {k: v[request.param] for k, v in SORT_SETTINGS.items()} | extra
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_positions_do_not_depend_on_the_sort(spark, odd_sorts):
    """Orders by few columns of wide rows, and groups with a third of all rows, against plain windows on full rows."""
    from pyspark.sql import Window

    from lakeops.operators import ordering
    from tests.conftest import SF_CHECK

    orders = Tables(spark, SF_CHECK).orders
    by = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    plain = orders.withColumn("pos", F.row_number().over(Window.orderBy(*by)).cast("long"))
    assert same(ordering.with_ordinal(orders, by, "pos"), plain)
    assert same(ordering.top_n(orders, by, 9001, "pos", deep_page_rows=50), plain.where("pos <= 9001"))
    assert same(ordering.page_slice(orders, by, 241, 50, "pos", deep_page_rows=50), plain.where("pos > 12000 and pos <= 12050"))
    hot = orders.withColumn("g", F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_custkey") % 40))
    w = Window.partitionBy("g").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    flag = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))
    got = ordering.with_group_running(hot, ["g"], by, [("n", "sum", F.lit(1)), ("low", "min", F.col("o_custkey")), ("last", "last", flag)])
    want = (hot.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("low", F.min("o_custkey").over(w))
            .withColumn("last", F.last(flag, True).over(w)))
    assert same(got.select(*want.columns), want.withColumn("n", F.col("n").cast("long")))


@pytest.mark.parametrize("name", ["sort_desc", "run_history", "sectioned_rows", "two_part_rows", "row_ordinal", "sorted_keys", "batch_number", "joined_lines"])
def test_ordered_queries_under_odd_sorts(spark, odd_sorts, name):
    """The queries on ordinals and running values equal their SQL whatever rows the sort has looked at and whatever its partitions."""
    import __spark_entry__ as entry
    from tests.conftest import SF_CHECK
    from tools.oracle_check import digest, duck_connect

    df = QUERIES[name](spark, SF_CHECK)
    found = duck_connect(SF_CHECK).execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, found.fetchall())[0]


def test_files_are_split_into_tasks(spark, tmp_path):
    """One CSV file, and one XML file, are read by many tasks."""
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("symbol"), F.lit("1").alias("position"),
                                      F.concat(F.lit("a\n<&\"'> \\n"), F.col("id").cast("string")).alias("fifoPnlUnrealized"))
    files.write_csv(rows.coalesce(1), str(tmp_path / "csv"), escaped_breaks=True)
    files.write_positions_xml(rows.coalesce(1), str(tmp_path / "xml"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        back = files.read_csv_text(spark, str(tmp_path / "csv"), escaped_breaks=True)
        assert back.rdd.getNumPartitions() > 4 and same(back, rows)
        xml = files.read_positions_xml(spark, str(tmp_path / "xml"))
        assert xml.rdd.getNumPartitions() > 4 and same(xml.select(*rows.columns), rows)
        assert same(files.read_positions_xml(spark, str(tmp_path / "xml"), splittable=False).select("symbol"), rows.select("symbol"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_anti_and_semi_joins_take_distinct_keys(spark):
    for name in ("keys_without_payload", "set_difference", "batch_members"):
        assert "HashAggregate" in plan(QUERIES[name](spark, SF_SMALL)), name


def test_stream_verdicts(spark):
    """All four verdicts, and a box that was not polled itself."""
    rows = [(0, "4"), (1, "4"), (2, "4"), (3, "4"), (4, "6"), (5, "1"), (6, "4"), (7, "1"), (9, "5"), (10, "4"), (13, "4"), (15, "4")]
    latest = spark.createDataFrame(rows, "job int, latest_status string")
    out = st.polled_verdicts(latest, "job", F.expr("job div 3"), F.col("job") % 3 == 0)
    assert {r.box: (r.box_status, r.n_children, r.verdict) for r in out.collect()} == {
        0: ("4", 2, "success"), 1: ("4", 2, "failed"), 2: ("4", 1, "open"), 3: ("5", 1, "not success"),
        4: (None, 1, "not success"), 5: ("4", 0, "success")}


def test_stream_restart_continues_from_its_checkpoint(spark, tmp_path):
    ev = Tables(spark, SF_SMALL).events
    landing, ckpt, out = str(tmp_path / "landing"), str(tmp_path / "ckpt"), str(tmp_path / "out")
    first, second = ev.where(F.col("event_id") % 2 == 0), ev.where(F.col("event_id") % 2 == 1)

    def run():
        stream = st.read_event_stream(spark, landing, ev.schema, files_per_trigger=2)
        latest = st.latest_status(stream, "user_id", "ts", "event_type", "event_id")
        st.run_available(latest, ckpt, "restart_check", "complete", st.snapshot_writer(out))

    st.land_files(first.repartition(4), landing)
    run()
    half = st.read_snapshot(spark, out).agg(F.sum("n_events")).first()[0]
    st.land_files(second.repartition(4), landing)
    run()  # same checkpoint: only the new files are read, the state carries the first half
    full = st.read_snapshot(spark, out)
    batch = ev.groupBy("user_id").agg(
        F.max(F.struct("ts", F.bitwise_not("event_id").alias("s"), "event_type")).alias("l"),
        F.count(F.lit(1)).alias("n_events")).select(
        "user_id", F.col("l.ts").alias("latest_ts"), F.col("l.event_type").alias("latest_status"), "n_events")
    assert half == first.count()
    assert full.exceptAll(batch).count() == 0 and batch.exceptAll(full).count() == 0


def test_date_range_predicates_tile_the_interval():
    import datetime as dt
    import re

    start, end = dt.date(2000, 2, 1), dt.date(2001, 8, 1)
    preds = jdbc.date_range_predicates("d", start, end, 12)
    bounds = [re.findall(r"DATE '([0-9-]+)'", p) for p in preds]
    assert len(preds) == 12 and bounds[0][0] == start.isoformat() and bounds[-1][1] == end.isoformat()
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    assert len(jdbc.date_range_predicates("d", start, start + dt.timedelta(days=3), 10)) == 3
    with pytest.raises(ValueError):
        jdbc.date_range_predicates("d", end, start, 4)


def test_bucketed_tables_join_without_shuffles(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["bucketed_payload_join"](spark, SF_SMALL))
        tree = text.split("\n\n")[0]
        assert "SortMergeJoin" in tree and "Exchange" not in tree and "SortAggregate" in tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_snapshot_survives_a_failed_batch(spark, tmp_path):
    path = str(tmp_path / "snap")
    for i in range(3):
        st.write_snapshot(spark.createDataFrame([(i,)], "v int"), path, i)
    assert [r.v for r in st.read_snapshot(spark, path).collect()] == [2]
    # batch 3 dies after replacing its slot and before its marker: readers still get batch 2
    spark.createDataFrame([(99,)], "v int").write.mode("overwrite").parquet(f"{path}/slot=1")
    assert [r.v for r in st.read_snapshot(spark, path).collect()] == [2]
    st.write_snapshot(spark.createDataFrame([(3,)], "v int"), path, 3)  # the replay
    assert [r.v for r in st.read_snapshot(spark, path).collect()] == [3]
    markers = spark.read.parquet(f"{path}/_batches")
    assert sorted((r.slot, r.batch_id) for r in markers.collect()) == [(0, 2), (1, 3)]  # two versions kept
