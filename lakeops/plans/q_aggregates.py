"""Counts and sums, the hit-ratio estimate, splits, distinct rows, replication, the tenor grid,
lookup broadcast and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.grid import TENORS, grid_totals
from lakeops.operators.lookup import lookup_join
from lakeops.operators.totals import column_sum, even_split, hit_ratio, measure_summary, row_count
from lakeops.plans.registry import query
from lakeops.tables import Tables

# Parameters of the registered queries.
SPLIT_PARTS = 8
COPIES = 50
DISTINCT_COLUMNS = ("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity")


@query("range_source", "P14", "SELECT o_orderkey AS number FROM orders")
def range_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored numbers, one column renamed by position."""
    return Tables(spark, sf_dir).orders.select("o_orderkey").toDF("number")


@query("range_sum", "G1", "SELECT CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders")
def range_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_sum(range_source(spark, sf_dir), "number", "total")


@query("row_count", "G2", "SELECT count(*) AS n_rows FROM lineitem")
def row_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(Tables(spark, sf_dir).lineitem)


@query("hit_ratio", "G3 F15", """SELECT hits, total, 4.0 * CAST(hits AS DOUBLE) / CAST(total AS DOUBLE) AS estimate
  FROM (SELECT count(*) FILTER (WHERE x * x + y * y <= 1.0) AS hits, count(*) AS total
        FROM (SELECT l_quantity / 50 AS x, l_discount * 10 AS y FROM lineitem))""")
def hit_ratio_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of lines whose (quantity, discount), scaled to the unit square, lies in the quarter circle."""
    li = Tables(spark, sf_dir).lineitem
    return hit_ratio(li.select((F.col("l_quantity") / 50).alias("x"), (F.col("l_discount") * 10).alias("y")))


@query("measure_summary", "G13", """SELECT event_type, count(value) AS n, round(avg(value), 4) AS avg_value,
    max(value) AS max_value, min(value) AS min_value, round(sum(value), 4) AS sum_value
  FROM events GROUP BY event_type""")
def measure_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_summary(Tables(spark, sf_dir).events, "value", ["event_type"])


@query("even_split", "W5", f"""SELECT o_orderpriority, CAST(i AS INTEGER) AS part_no,
    n // {SPLIT_PARTS} + CASE WHEN i < n % {SPLIT_PARTS} THEN 1 ELSE 0 END AS size
  FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority), range({SPLIT_PARTS}) t(i)""")
def even_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = Tables(spark, sf_dir).orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("o_orderpriority", F.posexplode(even_split(F.col("n"), SPLIT_PARTS)).alias("part_no", "size"))


@query("distinct_records", "G7 U2", f"SELECT DISTINCT {', '.join(DISTINCT_COLUMNS)} FROM lineitem")
def distinct_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).lineitem.select(*DISTINCT_COLUMNS).distinct()


@query("replicate_rows", "P12", f"""SELECT s.*, CAST(c AS INTEGER) AS copy FROM supplier s, range(1, {COPIES + 1}) t(c)""")
def replicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).supplier.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))


@query("tenor_grid", "J7", f"""SELECT r_regionkey, r_name, count(*) AS n_cells,
    round(sum(p_retailprice * (1 + r_regionkey) / t), 2) AS total_value
  FROM part, region, range(1, {TENORS + 1}) tt(t) GROUP BY r_regionkey, r_name""")
def tenor_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    out = grid_totals(t.part, F.col("p_retailprice"), t.region, ["r_regionkey", "r_name"],
                      F.lit(1) + F.col("r_regionkey"))
    return out.withColumn("total_value", F.round("total_value", 2))


@query("broadcast_lookup", "J6", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand,
    l.l_extendedprice FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    joined = lookup_join(li, parts, li["l_partkey"] == parts["p_partkey"])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand", "l_extendedprice")


@query("union_pages", "U1", """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
    c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return c.unionByName(s, allowMissingColumns=True)
