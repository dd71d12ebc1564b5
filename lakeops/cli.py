"""Command line for the reference's runnable jobs: ``python -m lakeops <job> ...``.

Each job is a few library calls on a Spark session; results are written to a path, or (for small
results) shown with ``show``, which prints a bounded number of rows.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeops.functions.predicates import ci_contains, date_window
from lakeops.functions.report import parse_section_text, parse_two_part_text
from lakeops.functions.text import shift_decode
from lakeops.functions.vectors import vector_parser
from lakeops.operators.hierarchy import expand_hierarchy
from lakeops.operators.ordering import page_count, page_slice
from lakeops.operators.runs import latest_run
from lakeops.operators.vector_job import run_totals, vector_results, vector_totals
from lakeops.session import cluster_settings, get_session, is_local
from lakeops.sources import files, jdbc, lake


def _replace_long(spark: SparkSession, a: argparse.Namespace) -> None:
    files.replace_long_entries(spark, a.input, a.output, a.column, a.max_length, a.multiline, a.escaped_breaks)


def _shift_decode(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = spark.read.text(a.input)
    lines.select(shift_decode("value", a.shift).alias("value")).write.mode("overwrite").text(a.output)


def _run_summary(spark: SparkSession, a: argparse.Namespace) -> None:
    runs = spark.read.parquet(a.runs).withColumn("seq", F.monotonically_increasing_id())
    jobs = latest_run(runs, "job_name", a.date_column, "status", "seq")
    jobs = jobs.where(ci_contains(F.col("job_name").cast("string"), a.search))
    jobs.agg(page_count(F.count(F.lit(1)), a.per_page).alias("total_pages")).show()
    page_slice(jobs, ["job_name"], a.page, a.per_page).show(a.per_page, truncate=False)


def _parse_report(spark: SparkSession, a: argparse.Namespace) -> None:
    texts = spark.read.text(a.input, wholetext=True).select(F.input_file_name().alias("doc"), "value")
    parse = parse_section_text if a.format == "sections" else parse_two_part_text
    parse(texts, "doc", "value").write.mode("overwrite").parquet(a.output)


def _positions(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = files.position_rows(files.read_positions_xml(spark, a.input))
    rows.drop("price", "pnl_unrealized").orderBy(F.col("value").desc_nulls_last(), "symbol").show(a.limit, truncate=False)


def _lake_copy(spark: SparkSession, a: argparse.Namespace) -> None:
    bounds = dict(partition_column=a.partition_column, lower_bound=a.lower_bound, upper_bound=a.upper_bound,
                  num_partitions=a.num_partitions) if a.partition_column else {}
    source = jdbc.read_table(spark, a.url, a.table, **bounds)
    lake.copy_to_lake(source, a.target, a.location, namespace_location=a.namespace_location,
                      using=a.using).show(truncate=False)


def _hierarchy(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = spark.read.text(a.input).select(F.get_json_object("value", "$.box").alias("box"), F.col("value").alias("json"))
    jobs = files.parse_job_lists(docs, "json", keep=["box"])
    edges = jobs.select(F.col("box").alias("parent"), F.col("name").alias("child"),
                        (F.upper("type") == F.lit("BOX")).alias("is_box"))
    found = expand_hierarchy(edges, a.root, expandable="is_box")
    # Only lists of boxes that were expanded count: the root, and what was found as a box.
    root = spark.range(1).select(F.lit(a.root).alias("box"))
    boxes = edges.where("is_box").select(F.col("child").alias("box")).join(found.select(F.col("node").alias("box")), "box", "left_semi")
    jobs = jobs.join(boxes.unionByName(root).distinct(), "box", "left_semi")
    fields = [f.name for f in files.JOB_FIELDS.fields]
    records = jobs.join(found, jobs["name"] == found["node"]).groupBy(*fields).agg(F.min("depth").alias("depth"))
    records.write.mode("overwrite").parquet(a.output)


def _key_job(spark: SparkSession, a: argparse.Namespace) -> None:
    keys = spark.read.parquet(a.keys)
    keys = date_window(keys, a.date_column, a.start, a.end)
    payload = spark.read.parquet(a.payload)
    parse = vector_parser(a.format, a.n)
    blob_cols = a.vectors.split(",")
    vectors = [parse(F.col(c)) for c in blob_cols]
    on = [a.date_column, a.id_column]
    renamed = payload.select(*[F.col(c).alias(f"_p_{c}") for c in on], *blob_cols)
    results = vector_results(keys.select(*on), renamed, on, [f"_p_{c}" for c in on], vectors, a.n, a.added)
    results.write.mode("overwrite").parquet(a.output)
    written = spark.read.parquet(a.output)
    daily = vector_totals(written, a.date_column)
    daily.orderBy(a.date_column).show(a.show, truncate=False)
    run_totals(daily, a.date_column).show(truncate=False)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeops")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("replace-long", help="replace over-long cells of a CSV column by 0")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("column")
    s.add_argument("--max-length", type=int, default=100)
    s.add_argument("--multiline", action="store_true", help="cells hold line breaks (a file is one task)")
    s.add_argument("--escaped-breaks", action="store_true", help="line breaks in cells are escaped")
    s.set_defaults(run=_replace_long)

    s = sub.add_parser("shift-decode", help="decode shift-ciphered text files")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--shift", type=int, default=3)
    s.set_defaults(run=_shift_decode)

    s = sub.add_parser("run-summary", help="latest run per job, searched and paged")
    s.add_argument("runs", help="parquet with job_name, status and a date column")
    s.add_argument("--date-column", default="date")
    s.add_argument("--search", default="")
    s.add_argument("--page", type=int, default=1)
    s.add_argument("--per-page", type=int, default=10)
    s.set_defaults(run=_run_summary)

    s = sub.add_parser("parse-report", help="report text files to table rows")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--format", choices=("sections", "two-part"), default="sections")
    s.set_defaults(run=_parse_report)

    s = sub.add_parser("positions", help="open positions from an XML report")
    s.add_argument("input")
    s.add_argument("--limit", type=int, default=50)
    s.set_defaults(run=_positions)

    s = sub.add_parser("hierarchy", help="all jobs below a box, expanding nested boxes, cycle-safe")
    s.add_argument("input", help='JSON lines {"box": ..., "jobs": [...]}, one per listed box')
    s.add_argument("output")
    s.add_argument("--root", required=True)
    s.set_defaults(run=_hierarchy)

    s = sub.add_parser("key-job", help="per key: first payload row, signed vector sum, status; totals per date")
    s.add_argument("--keys", required=True, help="parquet with the date and id columns")
    s.add_argument("--payload", required=True, help="parquet with the date, id and vector columns")
    s.add_argument("--vectors", required=True, help="comma-separated vector column names")
    s.add_argument("--output", required=True)
    s.add_argument("--date-column", default="businessdate")
    s.add_argument("--id-column", default="id")
    s.add_argument("--format", choices=("text", "float32"), default="text")
    s.add_argument("--n", type=int, default=5000)
    s.add_argument("--added", type=int, default=15)
    s.add_argument("--start")
    s.add_argument("--end")
    s.add_argument("--show", type=int, default=20)
    s.set_defaults(run=_key_job)

    s = sub.add_parser("lake-copy", help="copy a database table into a lake table and check it")
    s.add_argument("--url", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--target", required=True, help="catalog.namespace.table")
    s.add_argument("--location", help="table folder (default: the catalog's)")
    s.add_argument("--namespace-location", help="namespace folder when it is created (default: the catalog's)")
    s.add_argument("--using", default="parquet", help="table format, e.g. iceberg in a v2 catalog")
    s.add_argument("--partition-column")
    s.add_argument("--lower-bound")
    s.add_argument("--upper-bound")
    s.add_argument("--num-partitions", type=int)
    s.set_defaults(run=_lake_copy)
    return p


def _session() -> SparkSession:
    """A session with the cluster's settings, unless Spark runs in this process."""
    from pyspark import SparkConf

    return get_session(**({} if is_local(SparkConf().get("spark.master", "local[*]")) else cluster_settings()))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = build_parser().parse_args(argv)
    session = spark or _session()
    args.run(session, args)


if __name__ == "__main__":
    main(sys.argv[1:])
