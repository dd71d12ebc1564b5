"""Text cleaning, decoding, report parsing and report formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions.report import joined_lines, parse_section_text, parse_sections, parse_two_part_text, parse_two_parts
from lakeops.functions.text import (
    UPPER, LOWER, base64_decode, base64_text, replace_long, report_line, round_money, separator,
    shares_label, shift_decode, shift_encode,
)
from lakeops.plans.derive import marked_report_lines, text_reports, two_part_report_lines, two_part_reports
from lakeops.plans.registry import query
from lakeops.tables import Tables

# Parameters of the registered queries.
SHIFT = 3
MAX_LENGTH = 100
WIDTHS = (10, 5, 5)
SECOND_WIDTHS = (15, 7)
HEADER = ("STOCK", "QTY", "ACTION", "COMMENTS")
CHUNK_LINES = 1000

_SHIFTED = UPPER[SHIFT:] + UPPER[:SHIFT] + LOWER[SHIFT:] + LOWER[:SHIFT]


@query("replace_long", "P5", f"""SELECT conv_id, turn, role,
    CASE WHEN length(text) > {MAX_LENGTH} THEN '0' ELSE text END AS text FROM conversations""")
def replace_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", "role", replace_long("text", MAX_LENGTH).alias("text"))


@query("shift_decode", "F1", f"""SELECT doc_id, translate(text, '{UPPER + LOWER}', '{_SHIFTED}') AS encoded,
    text AS decoded FROM documents""")
def shift_decode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select("doc_id", shift_encode("text", SHIFT).alias("encoded"))
    return d.withColumn("decoded", shift_decode("encoded", SHIFT))


@query("base64_decode", "F2", """SELECT doc_id, to_base64(encode(text)) AS encoded, text AS decoded
  FROM documents""")
def base64_decode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select("doc_id", base64_text("text").alias("encoded"))
    return d.withColumn("decoded", base64_decode("encoded"))


@query("round_money", "F9", """SELECT c_custkey,
    CAST(round(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS money FROM customer""")
def round_money_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).customer.select("c_custkey", round_money("c_acctbal").alias("money"))


def _pad_sql(expr: str, width: int) -> str:
    return f"CASE WHEN length({expr}) < {width} THEN rpad({expr}, {width}, ' ') ELSE {expr} END"


_HEADER_TEXT = " | ".join(
    [h.ljust(w) for h, w in zip(HEADER, WIDTHS)] + [HEADER[-1]])
_LINE_SQL = " || ' | ' || ".join([
    _pad_sql("p_brand", WIDTHS[0]), _pad_sql("CAST(p_size AS VARCHAR)", WIDTHS[1]), _pad_sql("p_type", WIDTHS[2]),
    "p_name"])


@query("padded_lines", "F10 F11", f"""SELECT p_partkey, {_LINE_SQL} AS line FROM part
  UNION ALL SELECT -2, '{_HEADER_TEXT}'
  UNION ALL SELECT -1, repeat('-', {len(_HEADER_TEXT)})""")
def padded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    rows = p.select("p_partkey", report_line(
        [F.col("p_brand"), F.col("p_size").cast("string"), F.col("p_type"), F.col("p_name")],
        [*WIDTHS, None]).alias("line"))
    header = report_line([F.lit(h) for h in HEADER], [*WIDTHS, None])
    head = spark.range(1).select(F.lit(-2).cast("long").alias("p_partkey"), header.alias("line"))
    sep = spark.range(1).select(F.lit(-1).cast("long").alias("p_partkey"), separator(F.length(header)).alias("line"))
    return rows.unionByName(head).unionByName(sep)


_GEN_MARKED_SQL = """(SELECT conv_id, string_agg(line, chr(10) ORDER BY turn, sub) AS report FROM (
    SELECT conv_id, turn, 1 AS sub, concat_ws(' | ', role, CAST(turn AS VARCHAR), CAST(conv_id AS VARCHAR), 'x') AS line
      FROM conversations
    UNION ALL SELECT conv_id, turn, 0, 'Start Part 1' FROM conversations WHERE turn = 0
    UNION ALL SELECT conv_id, turn, 0, 'Start Part 2' FROM conversations WHERE turn = 2
    UNION ALL SELECT conv_id, turn, 2, 'End Part 1' FROM conversations WHERE turn = 1) GROUP BY conv_id)"""
_GEN_TWO_PART_SQL = """(SELECT conv_id, string_agg(line, chr(10) ORDER BY turn, sub) AS report FROM (
    SELECT conv_id, turn, 1 AS sub, concat_ws(' | ', role, CAST(turn AS VARCHAR), CAST(conv_id AS VARCHAR), 'x') AS line
      FROM conversations
    UNION ALL SELECT conv_id, turn, 0, 'PART 2' FROM conversations WHERE turn = 2) GROUP BY conv_id)"""


@query("sectioned_rows", "W4 F3", f"""WITH lines AS (
    SELECT conv_id, unnest(range(len(string_split(report, chr(10))))) AS line_no,
      regexp_replace(unnest(string_split(report, chr(10))), '^\\s+|\\s+$', '', 'g') AS line
    FROM {_GEN_MARKED_SQL}),
  flagged AS (SELECT *,
      coalesce(last_value(CASE WHEN line = 'Start Part 1' THEN true WHEN line = 'End Part 1' THEN false END IGNORE NULLS)
        OVER (PARTITION BY conv_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS in1,
      coalesce(last_value(CASE WHEN line = 'Start Part 2' THEN true WHEN line = 'End Part 2' THEN false
                               WHEN line = 'Start Part 1' THEN false END IGNORE NULLS)
        OVER (PARTITION BY conv_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS in2,
      list_transform(string_split(line, '|'), lambda c: regexp_replace(c, '^\\s+|\\s+$', '', 'g')) AS cells
    FROM lines),
  parted AS (SELECT *, CASE
      WHEN line NOT IN ('Start Part 1', 'End Part 1', 'Start Part 2', 'End Part 2') AND contains(line, '|')
           AND in1 AND len(cells) >= 4 THEN 1
      WHEN line NOT IN ('Start Part 1', 'End Part 1', 'Start Part 2', 'End Part 2') AND contains(line, '|')
           AND in2 AND len(cells) >= 3 THEN 2 END AS part FROM flagged)
  SELECT conv_id, line_no, part, cells[1] AS c1, cells[2] AS c2, cells[3] AS c3,
    CASE WHEN part = 1 THEN cells[4] END AS c4
  FROM parted WHERE part IS NOT NULL""")
def sectioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = marked_report_lines(Tables(spark, sf_dir).conversations)
    return parse_sections(lines, "conv_id", ["turn", "sub"], "line")


@query("two_part_rows", "F4", f"""WITH parts AS (
    SELECT conv_id, 1 AS part, string_split(report, 'PART 2')[1] AS body FROM {_GEN_TWO_PART_SQL}
    UNION ALL
    SELECT conv_id, 2, coalesce(string_split(report, 'PART 2')[2], '') FROM {_GEN_TWO_PART_SQL}),
  lines AS (SELECT conv_id, part, unnest(range(len(string_split(body, chr(10))))) AS line_no,
      unnest(string_split(body, chr(10))) AS line FROM parts)
  SELECT conv_id, part, line_no, line,
    CAST(len(string_split(line, '|')) AS INTEGER) AS n_cells,
    string_split(line, '|')[1] AS c1, string_split(line, '|')[2] AS c2,
    string_split(line, '|')[3] AS c3, string_split(line, '|')[4] AS c4
  FROM lines WHERE contains(line, '|')""")
def two_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = two_part_report_lines(Tables(spark, sf_dir).conversations)
    return parse_two_parts(lines, "conv_id", ["turn", "sub"], "line")


_LINES = "list_transform(range(len(l)), lambda i: concat_ws(' | ', role, CAST(i AS VARCHAR){}, l[i + 1]))"


@query("two_part_text_rows", "F4", f"""WITH t AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS l FROM conversations),
  r AS (SELECT conv_id, turn, string_split(array_to_string({_LINES.format(", CAST(conv_id AS VARCHAR)")}, chr(10)) || chr(10) || 'PART 2' || chr(10)
      || array_to_string({_LINES.format("")}, chr(10)), 'PART 2') AS p FROM t),
  parts AS (SELECT conv_id, turn, 1 AS part, string_split(p[1], chr(10)) AS b FROM r UNION ALL SELECT conv_id, turn, 2, string_split(p[2], chr(10)) FROM r),
  lines AS (SELECT conv_id, turn, part, unnest(range(len(b))) AS line_no, unnest(b) AS line FROM parts)
  SELECT conv_id, turn, part, line_no, line, CAST(len(string_split(line, '|')) AS INTEGER) AS n_cells, string_split(line, '|')[1] AS c1,
    string_split(line, '|')[2] AS c2, string_split(line, '|')[3] AS c3, string_split(line, '|')[4] AS c4 FROM lines WHERE contains(line, '|')""")
def two_part_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-part reports held in one text value each, with the whole texts of the conversations."""
    reports = two_part_reports(Tables(spark, sf_dir).conversations)
    rows = parse_two_part_text(reports.select(F.struct("conv_id", "turn").alias("doc"), "report"), "doc", "report")
    return rows.select("doc.conv_id", "doc.turn", *[c for c in rows.columns if c != "doc"])


@query("report_text_rows", "F3 F4 F10 W4 P11 O1", f"""WITH lines AS (
    SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM conversations),
  rows AS (
    SELECT conv_id, turn, 1 AS part, concat_ws(' | ', role, CAST(i AS VARCHAR), CAST(conv_id AS VARCHAR), x) AS line, i + 1 AS line_no FROM lines
    UNION ALL SELECT conv_id, turn, 2, concat_ws(' | ', role, CAST(i AS VARCHAR), x),
      i + 3 + count(*) OVER (PARTITION BY conv_id, turn, role) FROM lines),
  cells AS (SELECT conv_id, turn, part, line_no, list_transform(string_split(line, '|'), lambda c: trim(c)) AS c FROM rows)
  SELECT conv_id, turn, part, CAST(row_number() OVER (PARTITION BY conv_id, turn, part ORDER BY c[3], line_no) AS BIGINT) AS place,
    CASE WHEN part = 1 THEN {{one}} ELSE {{two}} END AS line
  FROM cells""".format(
    one=" || ' | ' || ".join([_pad_sql("c[1]", WIDTHS[0]), _pad_sql("c[2]", WIDTHS[1]), "c[3]"]),
    two=" || ' | ' || ".join([_pad_sql("c[1]", SECOND_WIDTHS[0]), _pad_sql("c[2]", SECOND_WIDTHS[1]), "c[3]"])))
def report_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports held in one text value each, with the whole texts of the conversations: both tables parsed, the
    comments dropped, the rows sorted by action within their table and set in the table's widths."""
    reports = text_reports(Tables(spark, sf_dir).conversations)
    rows = parse_section_text(reports.select(F.struct("conv_id", "turn").alias("doc"), "report"), "doc", "report")
    rows = rows.select(F.col("doc.conv_id").alias("conv_id"), F.col("doc.turn").alias("turn"), "part", "line_no", "c1", "c2", "c3")
    of_text = Window.partitionBy("conv_id", "turn", "part").orderBy("c3", "line_no")  # the lines of one text
    placed = rows.withColumn("place", F.row_number().over(of_text).cast("long"))
    cells = [F.col("c1"), F.col("c2"), F.col("c3")]
    line = F.when(F.col("part") == 1, report_line(cells, [*WIDTHS[:2], None])).otherwise(report_line(cells, [*SECOND_WIDTHS, None]))
    return placed.select("conv_id", "turn", "part", "place", line.alias("line"))


@query("joined_lines", "G16 F12", f"""SELECT l_orderkey, chunk, string_agg(line, chr(10) ORDER BY line) AS text FROM (
    SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY line) - 1) // {CHUNK_LINES} AS chunk FROM (
      SELECT l_orderkey, CAST(l_partkey AS VARCHAR) || ' (' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
        || ' shares)' AS line FROM lineitem))
  GROUP BY l_orderkey, chunk""")
def joined_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return joined_lines(li, "l_orderkey", shares_label("l_partkey", F.col("l_quantity").cast("long")), CHUNK_LINES)


@query("drop_columns", "P11", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).supplier.drop("s_acctbal")


@query("full_scan", "P9", "SELECT * FROM orders")
def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).orders.where(F.lit(True))
