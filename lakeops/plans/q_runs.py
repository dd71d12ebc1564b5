"""Job-run summaries, box verdicts, hierarchy, and the search/sort/page views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.predicates import ci_contains, ci_equals, retryable, status_class
from lakeops.operators.hierarchy import expand_hierarchy
from lakeops.operators.ordering import page_count, page_slice, top_n, with_ordinal
from lakeops.operators.runs import all_of_n_gate, box_verdict, child_flags, latest_run, newest_per_group, run_history, start_check
from lakeops.plans.derive import box_runs, child_runs, customer_edges, run_records
from lakeops.plans.registry import query
from lakeops.tables import Tables

# Parameters of the registered queries.
SEARCH = "Red"
JOB_SEARCH = "job_1"
JOB_PAGE = 2
PER_PAGE = 10
PAGE = 3
TOP_N = 5
GATE_N = 4
HIERARCHY_ROOT = 0
HIERARCHY_FANOUT = 7
SEGMENT = "building"
RETRY_CODE = 50
RETRY_WORDS = ("error",)

RUNS_SQL = """(SELECT user_id AS job_name, ts AS run_date,
    CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Success' END AS status, event_id AS seq FROM events)"""
CHILD_SQL = """(SELECT l_orderkey AS parent, l_linenumber AS child,
    CASE WHEN l_returnflag = 'R' THEN '6' WHEN l_linestatus = 'O' THEN '1' ELSE '4' END AS status FROM lineitem)"""
BOX_SQL = """(SELECT o_orderkey AS box, CASE WHEN o_orderstatus = 'F' THEN '4' ELSE '5' END AS box_status FROM orders)"""
FLAGS_SQL = f"""(SELECT parent, bool_or(status = '1') AS any_running, bool_and(status <> '1') AS none_running,
    bool_or(status = '6') AS any_terminated, count(*) AS n_children FROM {CHILD_SQL} GROUP BY parent)"""


@query("latest_run", "G5", f"""SELECT job_name, run_date AS latest_date, status AS latest_status, n_runs FROM (
    SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY run_date DESC, seq) AS rn,
      count(*) OVER (PARTITION BY job_name) AS n_runs FROM {RUNS_SQL}) WHERE rn = 1""")
def latest_run_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_run(run_records(Tables(spark, sf_dir).events))


@query("latest_run_window", "W1", """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def latest_run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_per_group(Tables(spark, sf_dir).events, ["user_id"], "ts", "event_id")


@query("run_history", "G6", f"""SELECT job_name, run_date, status, seq,
    row_number() OVER (PARTITION BY job_name ORDER BY run_date DESC, seq) AS run_rank FROM {RUNS_SQL}""")
def run_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_history(run_records(Tables(spark, sf_dir).events))


@query("parent_children", "J3", f"""SELECT b.box, b.box_status, c.child, c.status
  FROM {BOX_SQL} b JOIN {CHILD_SQL} c ON c.parent = b.box""")
def parent_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    boxes, children = box_runs(t.orders), child_runs(t.lineitem)
    return boxes.join(children, boxes["box"] == children["parent"]).select("box", "box_status", "child", "status")


@query("child_flags", "G8", f"SELECT * FROM {FLAGS_SQL}")
def child_flags_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return child_flags(child_runs(Tables(spark, sf_dir).lineitem))


@query("box_verdict", "G9 P7", f"""SELECT b.box, b.box_status, coalesce(f.n_children, 0) AS n_children,
    CASE WHEN coalesce(f.any_terminated, false) THEN 'failed' WHEN coalesce(f.any_running, false) THEN 'open'
         WHEN b.box_status = '4' THEN 'success' ELSE 'not success' END AS verdict
  FROM {BOX_SQL} b LEFT JOIN {FLAGS_SQL} f ON f.parent = b.box""")
def box_verdict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return box_verdict(box_runs(t.orders), child_runs(t.lineitem))


@query("all_of_n_gate", "G10", f"""SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS n_ok,
    CASE WHEN bool_or(l_returnflag = 'R') THEN 'failed'
         WHEN count(*) FILTER (WHERE l_linestatus = 'F') >= {GATE_N} THEN 'passed' ELSE 'missing' END AS gate
  FROM lineitem GROUP BY l_orderkey""")
def all_of_n_gate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return all_of_n_gate(li, "l_orderkey", F.col("l_linestatus") == "F", F.col("l_returnflag") == "R", GATE_N)


@query("start_check", "G8 G9 P7", f"""SELECT b.o_orderkey AS box, b.status AS box_status,
    CASE WHEN b.status = '1' OR coalesce(f.any_running, false) THEN 'refused' ELSE 'may start' END AS decision
  FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '1' WHEN 'F' THEN '4' ELSE '5' END AS status FROM orders) b
  LEFT JOIN {FLAGS_SQL} f ON f.parent = b.o_orderkey""")
def start_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    own = F.when(F.col("o_orderstatus") == "P", "1").when(F.col("o_orderstatus") == "F", "4").otherwise("5")
    boxes = t.orders.select(F.col("o_orderkey").alias("box"), own.alias("box_status"))
    return start_check(boxes, child_runs(t.lineitem))


@query("hierarchy_expand", "J4 U3", f"""WITH RECURSIVE edges AS (
    SELECT c_custkey // {HIERARCHY_FANOUT} AS parent, c_custkey AS child FROM customer),
  walk(node, depth) AS (
    SELECT child, 1 FROM edges WHERE parent = {HIERARCHY_ROOT}
    UNION
    SELECT e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.node WHERE w.depth < 40)
  SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY node""")
def hierarchy_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = customer_edges(Tables(spark, sf_dir).customer, HIERARCHY_FANOUT)
    return expand_hierarchy(edges, HIERARCHY_ROOT)


@query("status_class", "P7", """SELECT o_orderkey, status_code,
    CASE status_code WHEN '1' THEN 'running' WHEN '4' THEN 'success' WHEN '6' THEN 'terminated' ELSE 'other' END
      AS status_class
  FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'F' THEN '4' ELSE '6' END AS status_code
        FROM orders)""")
def status_class_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    code = F.when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", "4").otherwise("6")
    return o.select("o_orderkey", code.alias("status_code")).withColumn("status_class", status_class("status_code"))


@query("ci_equals", "P8", f"SELECT * FROM customer WHERE lower(c_mktsegment) = lower('{SEGMENT}')")
def ci_equals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).customer.where(ci_equals("c_mktsegment", SEGMENT))


@query("ci_search", "P6", f"SELECT * FROM part WHERE contains(lower(p_name), lower('{SEARCH}'))")
def ci_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).part.where(ci_contains("p_name", SEARCH))


@query("page_count", "G17", f"""SELECT count(*) AS total, {PER_PAGE} AS per_page,
    CAST(ceil(count(*) / {PER_PAGE}) AS BIGINT) AS total_pages
  FROM part WHERE contains(lower(p_name), lower('{SEARCH}'))""")
def page_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part.where(ci_contains("p_name", SEARCH))
    return p.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(PER_PAGE).alias("per_page"), page_count(F.col("total"), PER_PAGE).alias("total_pages"))


@query("page_slice", "O4", f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY p_name, p_partkey) AS position
    FROM part WHERE contains(lower(p_name), lower('{SEARCH}')))
  WHERE position > {(PAGE - 1) * PER_PAGE} AND position <= {PAGE * PER_PAGE}""")
def page_slice_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part.where(ci_contains("p_name", SEARCH))
    return page_slice(p, ["p_name", "p_partkey"], PAGE, PER_PAGE)


@query("top_n", "O3", f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank
    FROM customer) WHERE rank <= {TOP_N}""")
def top_n_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(Tables(spark, sf_dir).customer, [("c_acctbal", "desc"), "c_custkey"], TOP_N)


@query("sort_desc", "O2", """SELECT *, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS position
  FROM supplier""")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordinal(Tables(spark, sf_dir).supplier, [("s_acctbal", "desc"), "s_suppkey"], "position")


@query("row_ordinal", "W2", """SELECT o_orderkey, o_totalprice,
    row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS ordinal FROM orders""")
def row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return with_ordinal(o, [("o_totalprice", "desc"), "o_orderkey"], "ordinal")


@query("retryable_errors", "P13", f"""SELECT event_id, user_id, code, event_type AS message FROM (
    SELECT *, CASE WHEN user_id % 2 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS code
    FROM events)
  WHERE CASE WHEN code IS NOT NULL THEN code = {RETRY_CODE}
             ELSE {' OR '.join(f"contains(lower(event_type), '{w}')" for w in RETRY_WORDS)} END""")
def retryable_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    code = F.when(F.col("user_id") % 2 == 0, F.lit(None).cast("int")).otherwise(
        F.get_json_object("props", "$.k").try_cast("int"))
    ev = ev.select("event_id", "user_id", code.alias("code"), F.col("event_type").alias("message"))
    return ev.where(retryable("code", "message", RETRY_CODE, RETRY_WORDS))


@query("run_summary_page", "G5 P6 O4 G17", f"""SELECT * FROM (
    SELECT 'Job_' || CAST(job_name AS VARCHAR) AS job_label, latest_date, latest_status, n_runs,
      row_number() OVER (ORDER BY 'Job_' || CAST(job_name AS VARCHAR)) AS position,
      CAST(ceil(count(*) OVER () / {PER_PAGE}) AS BIGINT) AS total_pages
    FROM (SELECT job_name, run_date AS latest_date, status AS latest_status, n_runs FROM (
      SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY run_date DESC, seq) AS rn,
        count(*) OVER (PARTITION BY job_name) AS n_runs FROM {RUNS_SQL}) WHERE rn = 1)
    WHERE contains(lower('Job_' || CAST(job_name AS VARCHAR)), lower('{JOB_SEARCH}')))
  WHERE position > {(JOB_PAGE - 1) * PER_PAGE} AND position <= {JOB_PAGE * PER_PAGE}""")
def run_summary_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary view: latest run per job, filtered by a search on the job name, one page of the
    jobs in name order, with the page count."""
    latest = latest_run(run_records(Tables(spark, sf_dir).events))
    labelled = latest.select(F.concat(F.lit("Job_"), F.col("job_name").cast("string")).alias("job_label"),
                             "latest_date", "latest_status", "n_runs").where(ci_contains("job_label", JOB_SEARCH))
    pages = labelled.agg(page_count(F.count(F.lit(1)), PER_PAGE).alias("total_pages"))
    page = page_slice(labelled, ["job_label"], JOB_PAGE, PER_PAGE)
    return page.withColumn("total_pages", pages.scalar())


@query("run_page_rows", "G5 G6 P6 O4", f"""WITH runs AS (SELECT 'Job_' || CAST(job_name AS VARCHAR) AS job_label, run_date, status,
      row_number() OVER (PARTITION BY job_name ORDER BY run_date DESC, seq) AS run_rank FROM {RUNS_SQL}),
  page AS (SELECT job_label, row_number() OVER (ORDER BY job_label) AS position
    FROM (SELECT DISTINCT job_label FROM runs WHERE contains(lower(job_label), lower('{JOB_SEARCH}'))))
  SELECT page.job_label, page.position, runs.run_rank, runs.run_date, runs.status FROM page JOIN runs USING (job_label)
  WHERE position > {(JOB_PAGE - 1) * PER_PAGE} AND position <= {JOB_PAGE * PER_PAGE}""")
def run_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the jobs on one page of the summary, one row per run, newest first."""
    label = F.concat(F.lit("Job_"), F.col("job_name").cast("string"))
    runs = run_records(Tables(spark, sf_dir).events).withColumn("job_label", label)
    runs = runs.where(ci_contains("job_label", JOB_SEARCH))
    page = page_slice(runs.select("job_label").distinct(), ["job_label"], JOB_PAGE, PER_PAGE)
    on_page = runs.join(F.broadcast(page), "job_label")  # at most one page of job names
    history = run_history(on_page, "job_label")
    return history.select("job_label", "position", "run_rank", "run_date", "status")
