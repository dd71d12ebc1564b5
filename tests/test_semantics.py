
import datetime as dt
import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions import predicates as P
from lakeops.functions import report as R
from lakeops.functions import text as X
from lakeops.functions import vectors as V
from lakeops.operators import hierarchy, lookup, ordering, runs, totals
from lakeops.sources import files, lake


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- first row, ties, latest run ---------------------------------------------------------------

def test_first_row_per_key_uses_stated_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "b"), (1, 1, "a"), (2, 5, "z")], "k int, o int, v string")
    out = lookup.first_row_per_key(df, ["k"], ["o", "v"])
    assert rows(out, "k") == [(1, 1, "a"), (2, 5, "z")]


def test_key_payload_join_marks_missing_keys(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    payload = spark.createDataFrame([(1, "x"), (1, "w"), (3, "y")], "pk int, v string")
    out = lookup.key_payload_join(keys, payload, ["id"], ["pk"])
    assert rows(out, "id") == [(1, "w", "Found"), (2, None, "No data"), (3, "y", "Found")]


def test_latest_run_tie_keeps_first_in_input_order(spark):
    d = dt.datetime(2025, 10, 29, 18, 0)
    runs_df = spark.createDataFrame(
        [("A", d, "Failed", 1), ("A", d, "Success", 2), ("A", d - dt.timedelta(days=1), "Success", 3)],
        "job_name string, run_date timestamp, status string, seq int")
    out = runs.latest_run(runs_df)
    assert rows(out) == [("A", d, "Failed", 3)]


def test_run_history_newest_first(spark):
    base = dt.datetime(2025, 1, 1)
    data = [("A", base + dt.timedelta(hours=i), "Success", i) for i in range(5)]
    out = runs.run_history(spark.createDataFrame(data, "job_name string, run_date timestamp, status string, seq int"))
    assert [r.seq for r in out.orderBy("run_rank").collect()] == [4, 3, 2, 1, 0]


# --- skew-safe numbering against the plain window ---------------------------------------------

def test_group_row_number_matches_window_with_hot_key(spark):
    rnd = random.Random(7)
    data = [(0 if rnd.random() < 0.5 else rnd.randint(1, 40), i) for i in range(4000)]
    df = spark.createDataFrame(data, "g int, v int").repartition(8)
    fast = ordering.with_group_row_number(df, ["g"], ["v"], "rn")
    slow = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    assert sorted(rows(fast)) == sorted(rows(slow))


def test_group_row_number_null_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 1)], "g int, v int").repartition(4)
    out = ordering.with_group_row_number(df, ["g"], ["v"], "rn")
    assert sorted(r.rn for r in out.where("g is null").collect()) == list(range(1, 51))


def test_ordinal_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i * 7 % 1000,) for i in range(1000)], "v int").repartition(8)
    out = rows(ordering.with_ordinal(df, ["v"], "pos"), "pos")
    assert [p for _, p in out] == list(range(1, 1001))
    assert [v for v, _ in out] == sorted(v for v, _ in out)


def test_page_arguments_are_checked(spark):
    df = spark.range(5)
    with pytest.raises(ValueError):
        ordering.page_slice(df, ["id"], page=0)
    with pytest.raises(ValueError):
        ordering.page_slice(df, ["id"], per_page=51)
    assert [r.id for r in ordering.page_slice(df, ["id"], page=2, per_page=2).collect()] == [2, 3]


# --- hierarchy ------------------------------------------------------------------------------------

def test_hierarchy_cycle_and_root(spark):
    edges = spark.createDataFrame([("root", "a"), ("a", "b"), ("b", "a"), ("b", "root"), ("a", "c"),
                                   ("root", "c")], "parent string, child string")
    out = dict(rows(hierarchy.expand_hierarchy(edges, "root")))
    # the root is found through the cycle; every node once, at its first level
    assert out == {"a": 1, "c": 1, "b": 2, "root": 3}


def test_hierarchy_leaf_root_is_empty(spark):
    edges = spark.createDataFrame([(1, 2)], "parent long, child long")
    assert hierarchy.expand_hierarchy(edges, 5).count() == 0


def test_hierarchy_self_loop_at_root(spark):
    edges = spark.createDataFrame([(0, 0), (0, 1), (1, 2)], "parent long, child long")
    assert dict(rows(hierarchy.expand_hierarchy(edges, 0))) == {0: 1, 1: 1, 2: 2}


# --- verdicts and gates ---------------------------------------------------------------------------

def test_box_verdict_rules(spark):
    boxes = spark.createDataFrame([(1, "4"), (2, "4"), (3, "4"), (4, "5"), (5, "4")], "box int, box_status string")
    children = spark.createDataFrame([(1, 1, "6"), (1, 2, "1"), (2, 1, "1"), (3, 1, "4"), (4, 1, "4")],
                                     "parent int, child int, status string")
    out = {r.box: r.verdict for r in runs.box_verdict(boxes, children).collect()}
    assert out == {1: "failed", 2: "open", 3: "success", 4: "not success", 5: "success"}


def test_all_of_n_gate(spark):
    df = spark.createDataFrame([(1, True, False), (1, True, False), (2, True, False), (3, True, True)],
                               "p int, ok boolean, bad boolean")
    out = {r.p: r.gate for r in runs.all_of_n_gate(df, "p", F.col("ok"), F.col("bad"), 2).collect()}
    assert out == {1: "passed", 2: "missing", 3: "failed"}
    with pytest.raises(ValueError):
        runs.all_of_n_gate(df, "p", F.col("ok"), F.col("bad"), 0)


# --- scalar functions -----------------------------------------------------------------------------

def test_round_money_half_even_from_text(spark):
    df = spark.createDataFrame([("2.675",), ("2.665",), (None,), ("abc",), ("-1.005",)], "v string")
    assert [r[0] for r in df.select(X.round_money("v")).collect()] == [2.68, 2.66, None, None, -1.0]


def test_shift_decode_keeps_case_and_others(spark):
    df = spark.createDataFrame([("Khoor, Zruog! é",)], "t string")
    out = df.select(X.shift_decode("t", 3), X.shift_decode("t", 29), X.shift_encode(X.shift_decode("t", 3), 3)).first()
    assert out[0] == "Hello, World! é" and out[1] == out[0] and out[2] == "Khoor, Zruog! é"


def test_base64_roundtrip_and_line_breaks(spark):
    df = spark.createDataFrame([("héllo " * 40,)], "t string")
    enc = df.select(X.base64_text("t").alias("b")).first().b
    assert "\n" not in enc
    wrapped = "\n".join(enc[i:i + 60] for i in range(0, len(enc), 60))
    back = spark.createDataFrame([(wrapped,)], "b string").select(X.base64_decode("b")).first()[0]
    assert back == "héllo " * 40


def test_pad_never_cuts(spark):
    df = spark.createDataFrame([("AB",), ("ABCDEFGHIJKL",)], "s string")
    assert [r[0] for r in df.select(X.pad_cell("s", 10)).collect()] == ["AB        ", "ABCDEFGHIJKL"]


def test_replace_long_is_strict_and_counts_characters(spark):
    df = spark.createDataFrame([("é" * 100,), ("é" * 101,)], "s string")
    assert [r[0] for r in df.select(X.replace_long("s", 100)).collect()] == ["é" * 100, "0"]


def test_ci_contains_literal_wildcards(spark):
    df = spark.createDataFrame([("100% RED",), ("1000 red",)], "s string")
    assert df.where(P.ci_contains("s", "0%")).count() == 1
    assert df.where(P.ci_contains("s", "")).count() == 2


def test_retryable_code_wins(spark):
    df = spark.createDataFrame([(503, "x"), (500, "Service Unavailable"), (None, "HTTP 503"), (None, "ok")],
                               "code int, msg string")
    assert [r[0] for r in df.select(P.retryable("code", "msg")).collect()] == [True, False, True, False]


def test_even_split(spark):
    df = spark.createDataFrame([(10,), (2,)], "n long")
    assert [r[0] for r in df.select(totals.even_split(F.col("n"), 3)).collect()] == [[4, 3, 3], [1, 1, 0]]


def test_measure_summary_empty_gives_nulls(spark):
    df = spark.createDataFrame([], "v double")
    assert tuple(totals.measure_summary(df, "v").first()) == (0, None, None, None, None)


def test_positive_int_check():
    with pytest.raises(ValueError):
        totals.check_positive_int("draws", 0)
    with pytest.raises(ValueError):
        totals.check_positive_int("draws", True)
    assert totals.check_positive_int("draws", 5) == 5


# --- vectors ---------------------------------------------------------------------------------------

def test_parse_vector_errors(spark):
    df = spark.createDataFrame([("1,2,3",), (None,), ("1,x",), ("1,2",), ("1,x,3,4",)], "t string")
    out = df.select(V.parse_vector_text("t", 3).alias("v")).select("v", V.length_status("v", 3).alias("s")).collect()
    assert [list(r.v) for r in out] == [[1.0, 2.0, 3.0], [0.0] * 3, [0.0] * 3, [1.0, 2.0], [0.0] * 3]
    assert [r.s for r in out] == ["OK", "OK", "OK", "Error: expected 3 values in vector, found 2", "OK"]


def test_signed_sum_and_stats(spark):
    df = spark.createDataFrame([([1.0, 2.0], [10.0, 20.0], [0.5, 0.5])], "a array<float>, b array<float>, c array<float>")
    r = df.select(V.signed_sum(["a", "b", "c"], 2).alias("r")).select("r", V.vector_sum("r"), V.vector_max("r")).first()
    assert list(r[0]) == [10.5, 21.5] and r[1] == 32.0 and r[2] == 21.5


def test_binary_vector_roundtrip(spark):
    df = spark.createDataFrame([([1.5, -2.0, 3.25],), (None,)], "v array<float>")
    out = df.select(V.float32_from_bytes(V.float32_to_bytes("v")).alias("w")).collect()
    assert list(out[0].w) == [1.5, -2.0, 3.25] and out[1].w is None


# --- report parsers ----------------------------------------------------------------------------

def test_sections_two_flags(spark):
    text = "\n".join([
        "junk | a | b | c",
        "Start Part 1",
        " AAA | 1 | Buy | fine ",
        "Start Part 2",
        "BBB | 2 | Sell | x",      # both open: 4 cells -> part 1
        "R1 | high | hedge",       # both open: 3 cells -> part 2
        "End Part 1",
        "R2 | low | none | extra",  # only part 2 open: first 3 cells
        "Start Part 1",            # closes part 2
        "R3 | mid | wait",         # part 1 needs 4 cells: dropped
        "End Part 1",
        "CCC | 3 | Hold | late",   # nothing open
    ])
    df = spark.createDataFrame([(1, text)], "doc int, report string")
    out = rows(R.parse_section_text(df, "doc", "report"), "line_no")
    assert [(r[2], r[3], r[4], r[5], r[6]) for r in out] == [
        (1, "AAA", "1", "Buy", "fine"), (1, "BBB", "2", "Sell", "x"), (2, "R1", "high", "hedge", None),
        (2, "R2", "low", "none", None)]


def test_two_parts_without_marker_and_untrimmed(spark):
    df = spark.createDataFrame([(1, "H|Q\nA |1\nno pipe"), (2, "x|y\nPART 2: RISK|IMPACT\nr|i\nPART 2\nz|z")],
                               "doc int, report string")
    out = rows(R.parse_two_part_text(df, "doc", "report"), "doc", "part", "line_no")
    assert [(r[0], r[1], r[3]) for r in out] == [
        (1, 1, "H|Q"), (1, 1, "A |1"), (2, 1, "x|y"), (2, 2, ": RISK|IMPACT"), (2, 2, "r|i")]
    assert out[1][5] == "A "


# --- sources ----------------------------------------------------------------------------------

def test_job_list_defaults_for_missing_and_null(spark):
    docs = spark.createDataFrame([
        ('{"jobs": [{"name": "a", "type": "BOX", "runNum": 3}, {"name": null, "retry": null}]}',),
        ('{"jobs": null}',), ("not json",)], "json string")
    out = rows(files.parse_job_lists(docs, "json"))
    assert sorted(out) == sorted([("a", "BOX", 3, "N/A", "N/A", 0, "N/A"), ("N/A", "N/A", 0, "N/A", "N/A", 0, "N/A")])


def test_readback_check_detects_changed_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z")], "k int, v string")
    assert tuple(lake.readback_check(a, a).first()) == (2, 2, True)
    assert tuple(lake.readback_check(a, b).first()) == (2, 2, False)


def test_lookup_broadcast_is_size_checked(spark):
    from lakeops.operators.sizing import broadcast_if_small, measured_bytes

    dim = spark.createDataFrame([(1, "abc")], "k int, v string")
    assert measured_bytes(dim) == 16 + (4 + 8) + (3 + 16)
    def hinted(df):
        return "strategy=broadcast" in str(df._jdf.queryExecution().analyzed()).lower()

    assert hinted(broadcast_if_small(dim, 1000))
    assert not hinted(broadcast_if_small(dim, 10))


# --- hot keys: one key holds a third or more of the rows ---------------------------------------

def test_first_row_with_hot_key(spark):
    rnd = random.Random(3)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 300), rnd.randint(0, 10**6), i) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, o int, v int").repartition(8)
    got = dict((r.k, (r.o, r.v)) for r in lookup.first_row_per_key(df, ["k"], ["o", "v"]).collect())
    want = {}
    for k, o, v in data:
        want[k] = min(want.get(k, (o, v)), (o, v))
    assert got == want


def test_newest_per_group_with_hot_key(spark):
    data = [(0 if i % 2 else i % 7, i // 3, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, t int, seq int").repartition(8)
    got = {r.g: r.seq for r in runs.newest_per_group(df, ["g"], "t", "seq").collect()}
    want = {}
    for g, t, seq in data:
        if g not in want or (t, -seq) > want[g]:
            want[g] = (t, -seq)
    assert got == {g: -s for g, (t, s) in want.items()}


def test_hierarchy_hot_parent(spark):
    edges = [(0, i) for i in range(1, 2001)] + [(i, 5000 + i) for i in range(1, 11)]
    out = dict(rows(hierarchy.expand_hierarchy(spark.createDataFrame(edges, "parent long, child long"), 0)))
    assert len(out) == 2010 and out[1] == 1 and out[5001] == 2


def test_stream_watermark_needs_a_zoned_timestamp(spark, tmp_path):
    from lakeops.streaming import status as st

    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id long, ts timestamp_ntz")
    st.land_files(df, str(tmp_path / "in"))
    plain = st.read_event_stream(spark, str(tmp_path / "in"), df.schema)
    marked = st.read_event_stream(spark, str(tmp_path / "in"), df.schema, watermark="1 hour")
    assert plain.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert marked.schema["ts"].dataType.simpleString() == "timestamp"


def test_broadcast_threshold_follows_the_session(spark):
    from lakeops.operators.sizing import broadcast_limit, fits_broadcast, parse_bytes

    assert parse_bytes("64MB") == 64 * 1024 ** 2 and parse_bytes("-1") == -1
    dim = spark.createDataFrame([(1, "abc")], "k int, v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert broadcast_limit(dim) == 0 and not fits_broadcast(dim)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        assert fits_broadcast(dim)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_group_running_matches_windows_with_hot_key(spark):
    rnd = random.Random(11)
    data = [(0 if rnd.random() < 0.4 else rnd.randint(1, 30), i,
             rnd.choice([None, None, None, rnd.randint(-50, 50)])) for i in range(5000)]
    df = spark.createDataFrame(data, "g int, o int, v int").repartition(8)
    fast = ordering.with_group_running(df, ["g"], ["o"], [
        ("s", "sum", F.col("v")), ("m", "min", F.col("v")), ("l", "last", F.col("v"))])
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slow = df.select("g", "o", "v", F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("m"),
                     F.last("v", ignorenulls=True).over(w).alias("l"))
    assert sorted(rows(fast.select("g", "o", "v", "s", "m", "l"))) == sorted(rows(slow))


def test_vector_parser_choice(spark):
    df = spark.createDataFrame([("1,2",)], "t string")
    assert list(df.select(V.vector_parser("text", 2)("t")).first()[0]) == [1.0, 2.0]
    with pytest.raises(ValueError):
        V.vector_parser("pickle")
    with pytest.raises(ValueError):
        V.vector_parser("text")


def test_latest_run_since_limits_the_runs(spark):
    d = dt.datetime(2025, 10, 30)
    runs_df = spark.createDataFrame([("A", d, "Failed", 1), ("A", d - dt.timedelta(days=20), "Success", 2)],
                                    "job_name string, run_date timestamp, status string, seq int")
    out = runs.latest_run(runs_df, since=F.lit(d - dt.timedelta(days=10)))
    assert rows(out) == [("A", d, "Failed", 1)]


def test_overwrite_partitions_is_idempotent(spark, tmp_path):
    ns = "lakeops_test_ow"
    lake.create_namespace(spark, ns, str(tmp_path / "ns"))
    table = f"{ns}.t"
    lake.create_table(spark, table, "v INT, day STRING", ["day"], str(tmp_path / "t"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    lake.append(first, table)
    redo = spark.createDataFrame([(3, "b")], "v int, day string")
    lake.overwrite_partitions(redo, table)
    lake.overwrite_partitions(redo, table)
    assert sorted(rows(spark.table(table))) == [(1, "a"), (3, "b")]
    inventory = lake.file_inventory(spark.table(table), ["day"]).groupBy("day").agg(F.sum("record_count"))
    assert sorted(rows(inventory)) == [("a", 1), ("b", 1)]


def test_joined_lines_chunks_big_groups(spark):
    data = [(1, f"l{i:03d}") for i in range(25)] + [(2, "b"), (2, "a"), (None, "n")]
    out = rows(R.joined_lines(spark.createDataFrame(data, "g int, s string"), "g", F.col("s"), chunk_lines=10),
               "g", "chunk")
    assert out[0] == (None, 0, "n")
    assert [(g, c, t.count("\n") + 1) for g, c, t in out[1:4]] == [(1, 0, 10), (1, 1, 10), (1, 2, 5)]
    assert out[1][2].split("\n")[0] == "l000" and out[3][2].split("\n")[-1] == "l024"
    assert out[4] == (2, 0, "a\nb")


def test_copy_to_lake(spark, tmp_path):
    src = spark.createDataFrame([(1, "a", dt.date(2025, 12, 1)), (2, "b", dt.date(2025, 12, 1)),
                                 (3, "c", dt.date(2025, 12, 2))], "trade_id long, symbol string, business_date date")
    table = "lakeops_test_copy.trades"
    check = lake.copy_to_lake(src, table, str(tmp_path / "trades"), ["business_date"],
                              namespace_location=str(tmp_path / "ns"))
    assert tuple(check.first()) == (3, 3, True)
    rerun = lake.copy_to_lake(src, table, str(tmp_path / "trades"), ["business_date"], replace_partitions=True)
    assert tuple(rerun.first()) == (3, 3, True)
    again = lake.copy_to_lake(src, table)  # plain append, as in the reference: the rows are added once more
    assert tuple(again.first()) == (3, 3, True) and spark.table(table).count() == 6
    assert spark.table(table).columns == ["trade_id", "symbol", "business_date"]


def test_hierarchy_expands_only_boxes(spark):
    edges = spark.createDataFrame([("root", "b1", True), ("root", "j1", False), ("b1", "j2", False),
                                   ("j1", "x", False), ("b1", "b2", True), ("b2", "root", True)],
                                  "parent string, child string, is_box boolean")
    out = dict(rows(hierarchy.expand_hierarchy(edges, "root", expandable="is_box")))
    # j1 is recorded but, not being a box, its child x is never read
    assert out == {"b1": 1, "j1": 1, "j2": 2, "b2": 2, "root": 3}


def test_deep_pages_use_the_ordinal(spark):
    df = spark.createDataFrame([(i * 37 % 500, i) for i in range(500)], "k int, u int").repartition(4)
    for page in (1, 7, 50):
        shallow = rows(ordering.page_slice(df, ["k", "u"], page, 10), "position")
        deep = rows(ordering.page_slice(df, ["k", "u"], page, 10, deep_page_rows=5), "position")
        assert shallow == deep and [r[2] for r in deep] == list(range((page - 1) * 10 + 1, page * 10 + 1))


def test_large_top_n_uses_the_ordinal(spark):
    df = spark.createDataFrame([(i * 37 % 500, i) for i in range(500)], "k int, u int").repartition(4)
    a = rows(ordering.top_n(df, [F.col("k").desc(), "u"], 20), "rank")
    b = rows(ordering.top_n(df, [F.col("k").desc(), "u"], 20, deep_page_rows=5), "rank")
    assert a == b and [r[2] for r in b] == list(range(1, 21))


def test_values_by_hand(spark):
    """Rounding, number text, JSON numbers, vectors and report lines, each against the value it must give."""
    money = {"0.0149999999": 0.01, "0.015": 0.02, "0.025": 0.02, "123456789012345.67": 123456789012345.67, "1e30": 1e30, "-2.675": -2.68,
             "0.1234567890123456789012": 0.12, "x": None, "": None}
    df = spark.createDataFrame([(k,) for k in money], "t string")
    assert {r[0]: r[1] for r in df.select("t", X.round_money("t")).collect()} == money
    vec = {"1,2,3": [1.0, 2.0, 3.0], "1.0f,2,3": [0.0] * 3, "2.0d,1,1": [0.0] * 3, " 1e1 ,.5,-2.": [10.0, 0.5, -2.0], "1,,3": [0.0] * 3, "inf,1,2": [float("inf"), 1.0, 2.0]}
    df = spark.createDataFrame([(k,) for k in vec], "t string")
    assert {r[0]: r[1] for r in df.select("t", V.parse_vector_text("t", 3)).collect()} == vec
    blobs = spark.createDataFrame([(1, None), (2, bytearray(b"\0\0\x80?")), (3, bytearray(b"abc")), (4, bytearray())], "i int, b binary")
    parsed = {r[0]: r[1] for r in blobs.select("i", V.vector_parser("float32", 1)(F.col("b"))).collect()}
    assert parsed == {1: [0.0], 2: [1.0], 3: [0.0], 4: []}
    docs = spark.createDataFrame([('{"jobs":[{"name":"a","runNum":"5","retry":2.7},{"runNum":"x","retry":null},{"runNum":-3.9}]}',)], "j string")
    assert [(r.name, r.runNum, r.retry) for r in files.parse_job_lists(docs, "j").collect()] == [("a", 5, 2), ("N/A", 0, 0), ("N/A", -3, 0)]
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(X.report_line([F.col("a"), F.col("b"), F.col("c")], [2, 3, None])).first()[0] == "a  |     | c"


def test_null_payload_is_a_zero_vector(spark):
    from lakeops.operators.vector_job import vector_results

    keys = spark.createDataFrame([(i,) for i in range(1, 6)], "id int")
    one = bytearray(b"\0\0\x80?\0\0\0@")
    payload = spark.createDataFrame([(1, one, one), (2, None, one), (3, bytearray(b"abc"), one), (4, bytearray(b"\0\0\x80?"), one)], "k int, a binary, b binary")
    parse = V.vector_parser("float32", 2)
    out = vector_results(keys, payload, ["id"], ["k"], [parse("a"), parse("b")], 2, 1)
    assert sorted(rows(out)) == [(1, "Success", 0.0, 0.0), (2, "Success", -3.0, -1.0), (3, "Success", -3.0, -1.0),
                                 (4, "Error: expected 2 values in column 1, found 1", None, None), (5, "No data", None, None)]


def test_hierarchy_job_keeps_records_of_expanded_boxes(spark, tmp_path):
    from lakeops.cli import main

    docs = [{"box": "ROOT", "jobs": [{"name": "A", "type": "CMD", "runNum": 1}]}, {"box": "OTHER", "jobs": [{"name": "A", "type": "CMD", "runNum": 6}]}]
    (tmp_path / "in.json").write_text("\n".join(json.dumps(d) for d in docs))
    main(["hierarchy", str(tmp_path / "in.json"), str(tmp_path / "out"), "--root", "ROOT"], spark)
    assert [(r.name, r.runNum) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("A", 1)]
