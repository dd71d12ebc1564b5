"""The key-driven job: keys in a date range, first payload per key, row status, per-date and overall
totals, batches of keys. One DAG: one shuffle per side by key for the lookup and one by date for the
totals (after map-side partial aggregation); the date is only a group column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.predicates import date_window, key_equals, lookback_window
from lakeops.operators.lookup import NO_DATA, key_payload_join, keys_without_payload, members_of, split_payload_join
from lakeops.operators.ordering import first_n_per_group, with_group_row_number, with_ordinal
from lakeops.operators.totals import overall_totals, status_totals
from lakeops.plans.derive import LINEITEM_ORDER, order_keys
from lakeops.plans.registry import query
from lakeops.session import scratch_namespace, scratch_path
from lakeops.sources import lake
from lakeops.tables import Tables

# Parameters of the registered queries.
RANGE_START = "1990-01-01"
RANGE_END = "2030-01-01"
DATE_RANGE_START = "1997-01-01"
DATE_RANGE_END = "1998-01-01"
LOOKBACK_END = "2001-08-01"
BATCH_SIZE = 4
HOT_KEY, HOT_MOD = -1, 3  # every third order key is made one hot key
HOT_SHARE = 0.01
POINT_KEY = {"l_orderkey": 7, "l_linenumber": 1}

# DuckDB text shared by the oracles.
LINEITEM_ORDER_SQL = ", ".join(LINEITEM_ORDER)
FIRST_LINEITEM_SQL = f"""(SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER_SQL}) AS rn FROM lineitem)
  WHERE rn = 1)"""
KEYS_SQL = "(SELECT CAST(o_orderdate AS DATE) AS businessdate, o_orderkey AS id FROM orders)"
RANGE_KEYS_SQL = f"""(SELECT CAST(o_orderdate AS DATE) AS businessdate, o_orderkey AS id FROM orders
  WHERE o_orderdate >= TIMESTAMP '{RANGE_START}' AND o_orderdate < TIMESTAMP '{RANGE_END}')"""
STATUS_SQL = f"""(SELECT k.businessdate, k.id,
    CASE WHEN p.l_orderkey IS NULL THEN 'No data'
         WHEN p.l_quantity IS NULL OR p.l_quantity <= 0 THEN 'Error: quantity not positive'
         ELSE 'Success' END AS status
  FROM {RANGE_KEYS_SQL} k LEFT JOIN {FIRST_LINEITEM_SQL} p ON p.l_orderkey = k.id)"""
DAILY_SQL = f"""SELECT businessdate, count(*) AS total_ids,
    count(*) FILTER (WHERE status = 'Success') AS processed_records,
    count(*) FILTER (WHERE status = 'No data') AS no_data,
    count(*) FILTER (WHERE status LIKE 'Error%') AS errors
  FROM {STATUS_SQL} GROUP BY businessdate"""


def keyed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key in the range with the first lineitem of its order and a row status."""
    t = Tables(spark, sf_dir)
    keys = order_keys(date_window(t.orders, "o_orderdate", RANGE_START, RANGE_END))
    joined = key_payload_join(keys, t.lineitem, ["id"], ["l_orderkey"], LINEITEM_ORDER)
    q = F.col("l_quantity")
    status = (F.when(F.col("lookup_status") == NO_DATA, F.lit(NO_DATA))
              .when(q.isNull() | (q <= 0), F.lit("Error: quantity not positive"))
              .otherwise(F.lit("Success")))
    return joined.withColumn("status", status)


@query("daily_totals", "S4 P2 J1 J2 G11 O1", DAILY_SQL)
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_totals(keyed_status(spark, sf_dir), ["businessdate"])


@query("overall_totals", "G12", f"""SELECT count(businessdate) AS n_dates,
    CAST(sum(total_ids) AS BIGINT) AS total_ids, CAST(sum(processed_records) AS BIGINT) AS processed_records,
    CAST(sum(no_data) AS BIGINT) AS no_data, CAST(sum(errors) AS BIGINT) AS errors FROM ({DAILY_SQL})""")
def overall_totals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall_totals(daily_totals(spark, sf_dir), "businessdate")


@query("key_payload_join", "J1", f"""SELECT k.businessdate, k.id, p.l_partkey, p.l_suppkey, p.l_linenumber,
    p.l_quantity, p.l_extendedprice, p.l_discount, p.l_tax, p.l_returnflag, p.l_linestatus, p.l_shipdate,
    CASE WHEN p.l_orderkey IS NULL THEN 'No data' ELSE 'Found' END AS lookup_status
  FROM {KEYS_SQL} k LEFT JOIN {FIRST_LINEITEM_SQL} p ON p.l_orderkey = k.id""")
def key_payload_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = order_keys(t.orders)
    return key_payload_join(keys, t.lineitem, ["id"], ["l_orderkey"], LINEITEM_ORDER)


@query("keys_without_payload", "J2", """SELECT o.* FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def keys_without_payload_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return keys_without_payload(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"])


@query("set_difference", "U3", """SELECT o_orderkey AS orderkey FROM orders
  EXCEPT SELECT l_orderkey FROM lineitem""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return t.orders.select(F.col("o_orderkey").alias("orderkey")).subtract(t.lineitem.select("l_orderkey").distinct())


@query("date_range", "P2", f"""SELECT * FROM orders
  WHERE o_orderdate >= TIMESTAMP '{DATE_RANGE_START}' AND o_orderdate < TIMESTAMP '{DATE_RANGE_END}'""")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_window(Tables(spark, sf_dir).orders, "o_orderdate", DATE_RANGE_START, DATE_RANGE_END)


@query("lookback_547", "P3", f"""SELECT * FROM orders
  WHERE o_orderdate >= TIMESTAMP '{LOOKBACK_END}' - INTERVAL 547 DAY AND o_orderdate < TIMESTAMP '{LOOKBACK_END}'""")
def lookback_547(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookback_window(Tables(spark, sf_dir).orders, "o_orderdate", LOOKBACK_END)


@query("composite_lookup", "P4", f"""SELECT * FROM lineitem
  WHERE l_orderkey = {POINT_KEY['l_orderkey']} AND l_linenumber = {POINT_KEY['l_linenumber']}""")
def composite_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).lineitem.where(key_equals(POINT_KEY))


@query("keys_by_date", "G4", f"""SELECT businessdate, count(id) AS n_ids, count(DISTINCT id) AS n_distinct_ids,
    min(id) AS first_id, max(id) AS last_id FROM {KEYS_SQL} GROUP BY businessdate""")
def keys_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = order_keys(t.orders)
    return keys.groupBy("businessdate").agg(
        F.count("id").alias("n_ids"), F.countDistinct("id").alias("n_distinct_ids"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("sorted_keys", "O1", f"""SELECT businessdate, id,
    row_number() OVER (ORDER BY businessdate, id) AS position FROM {KEYS_SQL}""")
def sorted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = order_keys(t.orders)
    return with_ordinal(keys, ["businessdate", "id"], "position")


@query("batch_number", "W3", f"""SELECT businessdate, id,
    CAST(floor((row_number() OVER (PARTITION BY businessdate ORDER BY id) - 1) / {BATCH_SIZE}) AS BIGINT) AS batch_no
  FROM {KEYS_SQL}""")
def batch_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = order_keys(t.orders)
    numbered = with_group_row_number(keys, ["businessdate"], ["id"], "_rn")
    return numbered.select("businessdate", "id",
                           F.floor((F.col("_rn") - 1) / F.lit(BATCH_SIZE)).cast("long").alias("batch_no"))


@query("batch_members", "J8", f"""SELECT o.* FROM orders o WHERE (CAST(o.o_orderdate AS DATE), o.o_orderkey) IN (
    SELECT (businessdate, id) FROM (SELECT businessdate, id,
      row_number() OVER (PARTITION BY businessdate ORDER BY id) AS rn FROM {KEYS_SQL}) WHERE rn <= {BATCH_SIZE})""")
def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    first_batch = first_n_per_group(order_keys(t.orders), ["businessdate"], ["id"], BATCH_SIZE).select("businessdate", "id")
    orders = t.orders.withColumn("businessdate", F.col("o_orderdate").cast("date")).withColumn("id", F.col("o_orderkey"))
    return members_of(orders, first_batch, ["businessdate", "id"]).drop("businessdate", "id")


@query("row_status", "F14", """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
    CASE WHEN l_quantity IS NULL OR l_quantity = 0 THEN 'Error: quantity is zero'
         WHEN l_discount < 0 OR l_discount > 1 THEN 'Error: discount out of range'
         ELSE 'Success' END AS status FROM lineitem""")
def row_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row error capture: a bad row gets an error status and a null value; no row stops the job."""
    li = Tables(spark, sf_dir).lineitem
    q, d = F.col("l_quantity"), F.col("l_discount")
    status = (F.when(q.isNull() | (q == 0), F.lit("Error: quantity is zero"))
              .when((d < 0) | (d > 1), F.lit("Error: discount out of range"))
              .otherwise(F.lit("Success")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.try_divide(F.col("l_extendedprice"), q).alias("unit_price"), status.alias("status"))


@query("bucketed_payload_join", "J1 S14", f"""SELECT k.businessdate, k.id, p.l_partkey, p.l_suppkey, p.l_linenumber,
    p.l_quantity, p.l_extendedprice, p.l_discount, p.l_tax, p.l_returnflag, p.l_linestatus, p.l_shipdate,
    CASE WHEN p.l_orderkey IS NULL THEN 'No data' ELSE 'Found' END AS lookup_status
  FROM (SELECT CAST(o_orderdate AS DATE) AS businessdate, o_orderkey AS id FROM orders) k
  LEFT JOIN {FIRST_LINEITEM_SQL} p ON p.l_orderkey = k.id""")
def bucketed_payload_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-to-payload join on tables stored bucketed by the order key: the first-row aggregate and
    the join then run without shuffling either table."""
    t = Tables(spark, sf_dir)
    ns = scratch_namespace("bucketed")
    lake.create_namespace(spark, ns, scratch_path(spark, "ns-bucketed"))
    buckets = lake.bucket_count(t.lineitem)
    orders = lake.save_bucketed(t.orders.select("o_orderkey", "o_orderdate"), f"{ns}.orders", ["o_orderkey"],
                                buckets, scratch_path(spark, "tbl-orders-b"))
    lineitem = lake.save_bucketed(t.lineitem, f"{ns}.lineitem", ["l_orderkey"], buckets,
                                  scratch_path(spark, "tbl-lineitem-b"))
    keys = orders.select(F.col("o_orderdate").cast("date").alias("businessdate"), F.col("o_orderkey").alias("id"))
    return key_payload_join(keys, lineitem, ["id"], ["l_orderkey"], LINEITEM_ORDER)


def _heated(key: str):
    return F.when(F.col(key) % HOT_MOD == 0, F.lit(HOT_KEY).cast("long")).otherwise(F.col(key)).alias(key)


_HOT_SQL = f"CASE WHEN {{0}} % {HOT_MOD} = 0 THEN {HOT_KEY} ELSE {{0}} END"


@query("hot_payload_join", "J1 S14", f"""WITH li AS (SELECT * REPLACE ({_HOT_SQL.format("l_orderkey")} AS l_orderkey) FROM lineitem),
    first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINEITEM_ORDER_SQL}) AS rn FROM li) WHERE rn = 1)
  SELECT k.businessdate, k.id, k.o_orderkey, p.l_partkey, p.l_suppkey, p.l_linenumber, p.l_quantity, p.l_extendedprice, p.l_discount, p.l_tax,
    p.l_returnflag, p.l_linestatus, p.l_shipdate, CASE WHEN p.l_orderkey IS NULL THEN 'No data' ELSE 'Found' END AS lookup_status
  FROM (SELECT CAST(o_orderdate AS DATE) AS businessdate, {_HOT_SQL.format("o_orderkey")} AS id, o_orderkey FROM orders) k
  LEFT JOIN first p ON p.l_orderkey = k.id""")
def hot_payload_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-to-payload join on stored tables in which one key has a third of all rows: hot keys are found by a sketch
    and stored apart, the rest is joined without an exchange."""
    t = Tables(spark, sf_dir)
    ns = scratch_namespace("split")
    lake.create_namespace(spark, ns, scratch_path(spark, "ns-split"))
    payload = t.lineitem.select(*[_heated(c) if c == "l_orderkey" else F.col(c) for c in t.lineitem.columns])
    keys = t.orders.select(F.col("o_orderdate").cast("date").alias("businessdate"), _heated("o_orderkey").alias("id"), "o_orderkey")
    hot = sorted(set(lake.hot_keys(payload, ["l_orderkey"], HOT_SHARE)) | set(lake.hot_keys(keys, ["id"], HOT_SHARE)))
    buckets = lake.bucket_count(payload)
    stored = [lake.save_split(df, f"{ns}.{name}", by, buckets, hot, scratch_path(spark, f"tbl-split-{name}"))
              for df, name, by in ((keys, "keys", ["id"]), (payload, "payload", ["l_orderkey"]))]
    return split_payload_join(*stored, ["id"], ["l_orderkey"], LINEITEM_ORDER)
