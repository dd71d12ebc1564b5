"""Scans, sinks and lake tables. Every query writes what it derives from the given tables into a new
folder under the shared checkpoint root, then reads it back with the source under test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.listing import check_listings
from lakeops.operators.lookup import lookup_join
from lakeops.operators.ordering import with_group_row_number
from lakeops.plans.derive import order_keys
from lakeops.session import scratch_namespace, scratch_path, scratch_view
from lakeops.sources import files, lake, ledger
from lakeops.plans.registry import query
from lakeops.tables import Tables

# Parameters of the registered queries.
PAGES = 3
JOBS_PER_DOC = 100
MAX_LENGTH = 100
LEDGER_BATCH = 4  # rows of a batch
LISTED = "SELECT c_custkey, c_nationkey, lead(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS next FROM {}"
FIRST_LIMIT, LAST_LIMIT = 250_000, 400_000  # totals that are an error in the first run and in the restart
EVENT_COLUMNS_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                     "props STRING, day DATE")


def _namespace(spark: SparkSession, name: str) -> str:
    ns = scratch_namespace(name)
    lake.create_namespace(spark, ns, scratch_path(spark, f"ns-{name}"))
    return ns


@query("csv_scan", "S6", """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
    CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-part")
    files.write_csv(Tables(spark, sf_dir).part, path)
    return files.read_csv_text(spark, path)


@query("csv_roundtrip", "S7 P5", f"""SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
    CASE WHEN length(text) > {MAX_LENGTH} THEN '0' ELSE text END AS text FROM conversations""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, out = scratch_path(spark, "csv-in"), scratch_path(spark, "csv-out")
    files.write_csv(Tables(spark, sf_dir).conversations, src, escaped_breaks=True)
    return files.replace_long_entries(spark, src, out, "text", MAX_LENGTH, escaped_breaks=True)


@query("xml_positions", "S8 P10 F9", """SELECT c_name AS symbol, CAST(c_nationkey AS VARCHAR) AS qty,
    CASE WHEN c_custkey % 10 = 0 THEN NULL
         ELSE CAST(round(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(20,6)), 2) AS DOUBLE) END AS price,
    CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS pnl_unrealized FROM customer""")
def xml_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer
    report = c.select(F.col("c_name").alias("symbol"), F.col("c_nationkey").alias("position"),
                      F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("markPrice"))
    path = scratch_path(spark, "xml-positions")
    files.write_positions_xml(report, path)
    return files.position_rows(files.read_positions_xml(spark, path))


@query("json_jobs", "S9 F13", """SELECT 'job_' || CAST(event_id AS VARCHAR) AS name, upper(event_type) AS type,
    CASE WHEN event_id % 2 = 1 THEN 0 ELSE CAST(user_id AS INTEGER) END AS "runNum",
    'N/A' AS "startTime", 'N/A' AS "endTime", CAST(0 AS INTEGER) AS retry, 'N/A' AS status FROM events""")
def json_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    jobs = ev.select(
        "event_id",
        F.concat(F.lit("job_"), F.col("event_id").cast("string")).alias("name"),
        F.upper("event_type").alias("type"),
        F.when(F.col("event_id") % 2 == 0, F.col("user_id").try_cast("int")).alias("runNum"),
    )
    docs = files.job_list_json(jobs, F.expr(f"event_id div {JOBS_PER_DOC}"), "event_id")
    return files.parse_job_lists(docs, "json")


@query("paged_json_union", "S10", "SELECT * FROM customer")
def paged_json_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer
    path = scratch_path(spark, "json-pages")
    files.write_pages(c, path, F.col("c_custkey") % PAGES)
    return files.read_pages(spark, path, c.schema)


@query("object_listing", "S11", """SELECT c_nationkey, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS n_bytes
  FROM customer GROUP BY c_nationkey""")
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer.select("c_nationkey", F.col("c_name").alias("value"))
    path = scratch_path(spark, "objects")
    files.write_text_objects(c, path, mode="append", prefix_cols=["c_nationkey"])
    listing = files.list_objects(spark, path)
    return listing.groupBy("c_nationkey").agg(F.sum("length").alias("n_bytes"))


@query("object_text_sink", "S12", "SELECT c_name AS value FROM customer")
def object_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text-objects")
    files.write_text_objects(Tables(spark, sf_dir).customer.select(F.col("c_name").alias("value")), path)
    return spark.read.text(path)


def _events_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    ns = _namespace(spark, name)
    table = f"{ns}.events_by_day"
    lake.create_table(spark, table, EVENT_COLUMNS_DDL, ["day"], scratch_path(spark, f"tbl-{name}"))
    ev = Tables(spark, sf_dir).events.withColumn("day", F.col("ts").cast("date"))
    # Rows of a day meet before they are written, so that a day is few files; a hot day is split.
    lake.append(ev.hint("rebalance", F.col("day")), table)
    return table


@query("partitioned_table", "S13 S14 S15", "SELECT *, CAST(ts AS DATE) AS day FROM events")
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_events_table(spark, sf_dir, "partitioned"))


@query("partition_inventory", "S17", """SELECT CAST(ts AS DATE) AS day, count(*) AS record_count, true AS has_files, true AS complete
  FROM events GROUP BY CAST(ts AS DATE)""")
def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file inventory (path, partition, records) summed per partition, and checked against the table."""
    table = _events_table(spark, sf_dir, "inventory")
    inventory = lake.file_inventory(spark.table(table), ["day"])
    per_day = inventory.groupBy("day").agg(F.sum("record_count").alias("record_count"), F.count("file_path").alias("n_files"))
    held = spark.table(table).groupBy("day").agg(F.count(F.lit(1)).alias("held"))
    return per_day.join(held, "day").select("day", "record_count", (F.col("n_files") > 0).alias("has_files"),
                                            (F.col("record_count") == F.col("held")).alias("complete"))


@query("lake_append", "S15 P9", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer
    ns = _namespace(spark, "append")
    table = f"{ns}.customer_copy"
    lake.create_table(spark, table, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                      "c_mktsegment STRING", location=scratch_path(spark, "tbl-append"))
    lake.append(c, table)
    lake.append(c, table)
    return spark.table(table).where(F.lit(True))


@query("readback_check", "S16", "SELECT count(*) AS rows_in, count(*) AS rows_out, true AS matches FROM orders")
def readback_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders copied into a lake table; the source is read once, its fingerprint observed while written."""
    o = Tables(spark, sf_dir).orders
    ns = _namespace(spark, "readback")
    return lake.copy_to_lake(o, f"{ns}.orders_copy", scratch_path(spark, "tbl-rb"))


@query("merge_to_lake", "S20 J5 S6", """SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name, c.c_acctbal
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def merge_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relational table merged with a CSV file into a lake table, then read back."""
    t = Tables(spark, sf_dir)
    csv_path = scratch_path(spark, "csv-nation")
    files.write_csv(t.nation, csv_path)
    nation = files.read_csv_text(spark, csv_path).select(
        F.col("n_nationkey").try_cast("int").alias("n_nationkey"), "n_name")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    merged = lookup_join(c, nation, c["c_nationkey"] == nation["n_nationkey"]).select(
        "c_custkey", "c_name", "c_nationkey", "n_name", "c_acctbal")
    ns = _namespace(spark, "merge")
    table = f"{ns}.customer_nation"
    lake.create_table(spark, table, "c_custkey BIGINT, c_name STRING, c_nationkey INT, n_name STRING, c_acctbal DOUBLE",
                      location=scratch_path(spark, "tbl-merge"))
    lake.append(merged, table)
    return spark.table(table)


@query("warehouse_sql", "S5 O3", """SELECT * FROM customer ORDER BY c_custkey LIMIT 5""")
def warehouse_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL text run by the engine that holds the table, with the reference's ``LIMIT 5`` (ordered, so
    the rows are fixed). Against a database the same text goes through ``sources.jdbc.read_query``."""
    view = scratch_view("customer")
    Tables(spark, sf_dir).customer.createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view} ORDER BY c_custkey LIMIT 5")


@query("batch_ledger", "S18", f"""WITH n AS (SELECT CAST(o_orderdate AS DATE) AS businessdate, o_totalprice,
      (row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) - 1) // {LEDGER_BATCH} AS batch_no FROM orders)
  SELECT businessdate, batch_no, count(*) AS n_rows, CAST(CASE WHEN max(o_totalprice) >= {FIRST_LIMIT} THEN 2 ELSE 1 END AS BIGINT) AS attempts,
    max(o_totalprice) < {LAST_LIMIT} AS committed, CASE WHEN max(o_totalprice) < {LAST_LIMIT} THEN count(*) ELSE 0 END AS rows_held
  FROM n GROUP BY businessdate, batch_no""")
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows in batches of a date, committed or rolled back one by one; a restart with a wider limit takes up only
    the batches that the first run rolled back. Per batch: attempts, outcome, and the rows that are visible."""
    orders = Tables(spark, sf_dir).orders
    keyed = order_keys(orders).join(orders.select(F.col("o_orderkey").alias("id"), "o_totalprice"), "id")
    numbered = with_group_row_number(keyed, ["businessdate"], ["id"], "_rn")
    rows = numbered.withColumn("batch_no", F.expr(f"(_rn - 1) div {LEDGER_BATCH}")).drop("_rn")
    path, batch = scratch_path(spark, "batch-ledger"), ["businessdate", "batch_no"]
    for limit in (FIRST_LIMIT, LAST_LIMIT):
        ledger.write_in_batches(rows, batch, path, F.when(F.col("o_totalprice") >= limit, F.lit("Error: total out of range")))
    told = ledger.read_ledger(spark, path).groupBy(*batch).agg(
        F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("attempts"), F.bool_or(F.col("status") == ledger.COMMITTED).alias("committed"))
    held = ledger.committed_rows(spark, path, batch).groupBy(*batch).agg(F.count(F.lit(1)).alias("rows_held"))
    return told.join(held, batch, "left").withColumn("rows_held", F.coalesce("rows_held", F.lit(0).cast("long")))


@query("append_inventory", "S16 S17", """SELECT CAST(ts AS DATE) AS day, count(*) AS record_count FROM events
  WHERE event_id % 4 = 3 GROUP BY CAST(ts AS DATE)""")
def append_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per partition in the files that an append added to a table with three times as many rows; only these
    files are read."""
    ns = _namespace(spark, "added")
    table = f"{ns}.events_by_day"
    lake.create_table(spark, table, EVENT_COLUMNS_DDL, ["day"], scratch_path(spark, "tbl-added"))
    ev = Tables(spark, sf_dir).events.withColumn("day", F.col("ts").cast("date"))
    newest = F.col("event_id") % 4 == 3
    lake.append(ev.where(~newest).hint("rebalance", F.col("day")), table)
    added = lake.append_files(ev.where(newest).hint("rebalance", F.col("day")), table)
    return lake.file_inventory(lake.read_files(spark, table, added), ["day"]).groupBy("day").agg(F.sum("record_count").alias("record_count"))


@query("listing_check", "S10", f"""WITH RECURSIVE l AS ({LISTED.format("customer")}),
    p AS (SELECT c_nationkey AS listing, c_custkey AS page, CASE WHEN c_custkey % 83 = 0 THEN c_custkey - c_custkey % 7 ELSE next END AS next,
        c_custkey = min(c_custkey) OVER (PARTITION BY c_nationkey) AS first, CASE WHEN c_custkey % 61 = 0 THEN 2 ELSE 1 END AS copies FROM l),
    landed AS (SELECT * FROM p WHERE page % 71 <> 0),
    walk AS (SELECT listing, page, next, page AS origin FROM landed UNION SELECT n.listing, n.page, n.next, w.origin
             FROM walk w JOIN landed n ON n.listing = w.listing AND n.page = w.next),
    ends AS (SELECT listing, origin, count(*) AS steps, bool_or(next IS NULL OR NOT EXISTS
               (SELECT 1 FROM landed x WHERE x.listing = walk.listing AND x.page = walk.next)) AS ended FROM walk GROUP BY ALL),
    c AS (SELECT landed.listing, count(*) AS n_pages, CAST(count(*) FILTER (first) = 0 AS BIGINT) AS n_no_first, CAST(sum(copies - 1) AS BIGINT) AS n_repeated,
        count(*) FILTER (landed.next IS NOT NULL AND NOT EXISTS (SELECT 1 FROM landed x WHERE x.listing = landed.listing AND x.page = landed.next)) AS n_gaps,
        count(*) FILTER (NOT ended) AS n_looping, count(*) - coalesce(max(steps) FILTER (first AND ended), 0) AS n_off_chain
      FROM landed JOIN ends ON ends.listing = landed.listing AND origin = page GROUP BY landed.listing)
  SELECT *, CASE WHEN n_no_first > 0 THEN 'no first page' WHEN n_repeated > 0 THEN 'page landed twice' WHEN n_gaps > 0 THEN 'gap'
    WHEN n_looping > 0 THEN 'loop' WHEN n_off_chain > 0 THEN 'page off the chain' ELSE 'complete' END AS status FROM c""")
def listing_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's customers as a listing of one page each, landed as JSON, with pages missing, repeated, or linked
    to the wrong page; the status of each listing."""
    c = Tables(spark, sf_dir).customer
    view = scratch_view("listed")
    c.createOrReplaceTempView(view)
    key = F.col("c_custkey")
    pages = spark.sql(LISTED.format(view)).select(
        F.col("c_nationkey").alias("listing"), key.alias("page"), F.when(key % 83 == 0, key - key % 7).otherwise(F.col("next")).alias("next"),
        F.explode(F.sequence(F.lit(1), F.when(key % 61 == 0, 2).otherwise(1))).alias("copy")).where(key % 71 != 0).drop("copy")
    firsts = c.groupBy(F.col("c_nationkey").alias("listing")).agg(F.min("c_custkey").alias("first_page"))
    path = scratch_path(spark, "json-listing")
    files.write_pages(lookup_join(pages, firsts, "listing").select("listing", F.col("page").alias("id"), "next", "first_page"), path, F.col("id") % PAGES)
    landed = files.read_pages(spark, path, T.StructType([T.StructField("listing", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in ("id", "next", "first_page")]]))
    return check_listings(landed, "listing", "id", "next", F.col("id") == F.col("first_page"))
