"""Vector columns: wide projection, parsing, checks, signed sums and summaries, and the per-date job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.vectors import (
    OK, float32_from_bytes, float32_to_bytes, length_status, parse_vector_text, signed_sum, split_vector,
    vector_max, vector_parser, vector_sum,
)
from lakeops.operators.vector_job import vector_results, vector_totals
from lakeops.plans.derive import LINEITEM_ORDER, business_date, cut_vectors, order_keys, payload_texts, vector_texts
from lakeops.plans.q_keyed import FIRST_LINEITEM_SQL, KEYS_SQL
from lakeops.plans.registry import query
from lakeops.session import scratch_namespace, scratch_path
from lakeops.sources import lake
from lakeops.tables import Tables

# Parameters of the registered queries.
WIDE_COLUMNS = 64
VECTOR_LEN = 64
PARTS = 4
PART_LEN = 16
ADDED = 2

_DSUM = "list_reduce(list_transform({v}, lambda x: x::DOUBLE), lambda a, b: a + b)"


@query("wide_projection", "P1", "SELECT vec_id, " + ", ".join(
    f"embedding[{i}] AS e_{i}" for i in range(1, WIDE_COLUMNS + 1)) + " FROM embeddings")
def wide_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"e_{i}" for i in range(1, WIDE_COLUMNS + 1)]
    e = Tables(spark, sf_dir).embeddings
    return e.select("vec_id", *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)])


@query("parse_vector", "F5 F7 F8", f"""SELECT vec_id,
    CASE WHEN vec_id % 11 = 0 OR vec_id % 10 = 0 THEN 'OK'
         WHEN vec_id % 13 = 0 THEN 'Error: expected {VECTOR_LEN} values in vector, found {VECTOR_LEN - 1}'
         ELSE 'OK' END AS status,
    CAST(CASE WHEN vec_id % 11 = 0 OR vec_id % 10 = 0 THEN {VECTOR_LEN}
         WHEN vec_id % 13 = 0 THEN {VECTOR_LEN - 1} ELSE len(embedding) END AS INTEGER) AS n_elements,
    CASE WHEN vec_id % 11 = 0 OR vec_id % 10 = 0 THEN 0.0::DOUBLE WHEN vec_id % 13 = 0 THEN NULL
         ELSE {_DSUM.format(v='embedding')} END AS v_sum,
    CASE WHEN vec_id % 11 = 0 OR vec_id % 10 = 0 THEN 0.0::FLOAT WHEN vec_id % 13 = 0 THEN NULL
         ELSE list_max(embedding) END AS v_max
  FROM embeddings""")
def parse_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = vector_texts(Tables(spark, sf_dir).embeddings)
    v = texts.select("vec_id", parse_vector_text("vector_text", VECTOR_LEN).alias("v"))
    status = length_status("v", VECTOR_LEN)
    ok = status == OK
    return v.select("vec_id", status.alias("status"), F.size("v").alias("n_elements"),
                    F.when(ok, vector_sum("v")).alias("v_sum"), F.when(ok, vector_max("v")).alias("v_max"))


@query("vector_length_status", "F8", f"""SELECT vec_id, CAST(len(v) AS INTEGER) AS n_elements,
    CASE WHEN len(v) = {VECTOR_LEN} THEN 'OK'
         ELSE 'Error: expected {VECTOR_LEN} values in vector, found ' || len(v) END AS status
  FROM (SELECT vec_id, CASE WHEN vec_id % 13 = 0 THEN embedding[1:len(embedding) - 1] ELSE embedding END AS v
        FROM embeddings)""")
def vector_length_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = cut_vectors(Tables(spark, sf_dir).embeddings)
    return v.select("vec_id", F.size("embedding").alias("n_elements"),
                    length_status("embedding", VECTOR_LEN).alias("status"))


def _signed_sql(i: int) -> str:
    terms = [f"embedding[{p * PART_LEN + i}]::DOUBLE" for p in range(PARTS)]
    expr = terms[0]
    for p, t in enumerate(terms[1:], start=1):
        expr = f"({expr} {'+' if p < ADDED else '-'} {t})"
    return expr


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings
    return e.select("vec_id", signed_sum(split_vector("embedding", PARTS, PART_LEN), ADDED).alias("r"))


@query("signed_vector_sum", "G14", "SELECT vec_id, " + ", ".join(
    f"{_signed_sql(i)} AS r_{i}" for i in range(1, PART_LEN + 1)) + " FROM embeddings")
def signed_vector_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _signed(spark, sf_dir)
    return r.select("vec_id", *[F.col("r")[i].alias(f"r_{i + 1}") for i in range(PART_LEN)])


@query("vector_stats", "G15", f"""SELECT vec_id, {_DSUM.format(v='r')} AS v_sum, list_max(r) AS v_max FROM (
    SELECT vec_id, [{', '.join(_signed_sql(i) for i in range(1, PART_LEN + 1))}] AS r FROM embeddings)""")
def vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _signed(spark, sf_dir)
    return r.select("vec_id", vector_sum("r").alias("v_sum"), vector_max("r").alias("v_max"))


@query("binary_vector", "F6 X2", f"""SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_elements,
    {_DSUM.format(v='embedding')} AS v_sum, list_max(embedding) AS v_max FROM embeddings""")
def binary_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings
    raw = e.select("vec_id", float32_to_bytes("embedding").alias("blob"))
    v = raw.select("vec_id", float32_from_bytes("blob").alias("v"))
    return v.select("vec_id", F.size("v").alias("n_elements"), vector_sum("v").alias("v_sum"),
                    vector_max("v").alias("v_max"))


_RESULTS_SQL = f"""(SELECT k.businessdate, k.id, p.l_orderkey IS NOT NULL AS found,
      ((p.l_quantity + p.l_extendedprice) - p.l_discount) - p.l_tax AS result_sum
    FROM {KEYS_SQL} k LEFT JOIN {FIRST_LINEITEM_SQL} p ON p.l_orderkey = k.id)"""


def key_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-driven vector job on the TPC-H tables: each key's first lineitem is the payload and its
    four measures are one-element vectors, the first two added and the last two subtracted."""
    t = Tables(spark, sf_dir)
    keys = order_keys(t.orders)
    vectors = [F.array(F.col(c)) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    return vector_results(keys, t.lineitem, ["id"], ["l_orderkey"], vectors, 1, ADDED, LINEITEM_ORDER)


@query("per_date_job", "X3 J1 F8 G14 G15 G11", f"""SELECT businessdate, count(*) AS total_ids,
    count(*) FILTER (WHERE found) AS processed_records, count(*) FILTER (WHERE NOT found) AS no_data,
    CAST(0 AS BIGINT) AS errors, round(sum(result_sum), 2) AS result_total, max(result_sum) AS result_max
  FROM {_RESULTS_SQL} GROUP BY businessdate""")
def per_date_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per date of :func:`key_results`, in one aggregation."""
    return vector_totals(key_results(spark, sf_dir), "businessdate", digits=2)


@query("result_rows", "S18 X3", f"""SELECT businessdate, id, CASE WHEN found THEN 'Success' ELSE 'No data' END AS status,
    CASE WHEN found THEN result_sum END AS result_sum, CASE WHEN found THEN result_sum END AS result_max
  FROM {_RESULTS_SQL}""")
def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-key results written to a result table (the batched insert of the job, aimed at a lake
    table here) and read back."""
    ns = scratch_namespace("results")
    lake.create_namespace(spark, ns, scratch_path(spark, "ns-results"))
    table = f"{ns}.key_results"
    lake.create_table(spark, table, "businessdate DATE, id BIGINT, status STRING, result_sum DOUBLE, result_max DOUBLE",
                      location=scratch_path(spark, "tbl-results"))
    lake.append(key_results(spark, sf_dir), table)
    return spark.table(table)


def _part_sql(i: int) -> str:
    zeros = "[" + ", ".join(["0.0::FLOAT"] * PART_LEN) + "]"
    own = f"list_slice(embedding, {1 + i * PART_LEN}, {(i + 1) * PART_LEN})"
    bad = {0: "vec_id % 10 = 0", 1: "vec_id % 11 = 0", 3: "vec_id % 17 = 0"}.get(i)
    return own if bad is None else f"CASE WHEN {bad} THEN {zeros} ELSE {own} END"


_STORED_SQL = f"""(SELECT CAST(o_orderdate AS DATE) AS businessdate, o_orderkey, r, vec_id
  FROM orders LEFT JOIN (SELECT vec_id, list_transform(range(1, {PART_LEN + 1}), lambda i:
      ((p1[i]::DOUBLE + p2[i]::DOUBLE) - p3[i]::DOUBLE) - p4[i]::DOUBLE) AS r
    FROM (SELECT vec_id, {", ".join(f"{_part_sql(i)} AS p{i + 1}" for i in range(PARTS))} FROM embeddings)) ON vec_id = o_custkey)"""


@query("stored_vector_job", "X3 F5 F7 F8 X2 G14 G15 G11", f"""SELECT businessdate, count(*) AS total_ids,
    count(*) FILTER (WHERE vec_id IS NOT NULL AND vec_id % 13 <> 0) AS processed_records,
    count(*) FILTER (WHERE vec_id IS NULL) AS no_data, count(*) FILTER (WHERE vec_id % 13 = 0) AS errors,
    round(sum(CASE WHEN vec_id % 13 <> 0 THEN list_reduce(r, lambda a, b: a + b) END), 4) AS result_total,
    max(CASE WHEN vec_id % 13 <> 0 THEN list_max(r) END) AS result_max
  FROM {_STORED_SQL} GROUP BY businessdate""")
def stored_vector_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-driven vector job on stored text payloads: the keys of orders (by customer), four vector columns,
    among them null, unreadable and short ones."""
    t = Tables(spark, sf_dir)
    keys = t.orders.select(business_date("o_orderdate").alias("businessdate"), F.col("o_custkey").alias("id"))
    parse = vector_parser("text", PART_LEN)
    payload = payload_texts(t.embeddings, PARTS, PART_LEN)
    vectors = [parse(F.col(f"v{i + 1}")) for i in range(PARTS)]
    results = vector_results(keys, payload, ["id"], ["vec_id"], vectors, PART_LEN, ADDED)
    return vector_totals(results, "businessdate", digits=4)
