"""Inputs of the reference's shapes, derived from the given tables with Spark (FIXTURES.md section 3).

Each recipe is plain column expressions on the tables, so the same rows can be written in SQL for the
DuckDB check and every derived input grows with the tables it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the derivations.
LINEITEM_ORDER = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def business_date(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("date")


def order_keys(orders: DataFrame) -> DataFrame:
    """Keys table: (businessdate, id) from orders."""
    return orders.select(business_date("o_orderdate").alias("businessdate"), F.col("o_orderkey").alias("id"))


def run_records(events: DataFrame) -> DataFrame:
    """Job runs: job_name = user_id, date = ts, status Failed for error events, else Success."""
    return events.select(
        F.col("user_id").alias("job_name"),
        F.col("ts").alias("run_date"),
        F.when(F.col("event_type") == "error", F.lit("Failed")).otherwise(F.lit("Success")).alias("status"),
        F.col("event_id").alias("seq"),
    )


def child_runs(lineitem: DataFrame) -> DataFrame:
    """Child runs of a box: parent = l_orderkey; 6 terminated when returned, 1 running when open, else 4."""
    status = (F.when(F.col("l_returnflag") == "R", F.lit("6"))
              .when(F.col("l_linestatus") == "O", F.lit("1"))
              .otherwise(F.lit("4")))
    return lineitem.select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("child"),
                           status.alias("status"))


def box_runs(orders: DataFrame) -> DataFrame:
    """Parent (box) runs: status 4 when the order is finished, else 5."""
    return orders.select(F.col("o_orderkey").alias("box"),
                         F.when(F.col("o_orderstatus") == "F", F.lit("4")).otherwise(F.lit("5")).alias("box_status"))


def customer_edges(customer: DataFrame, fanout: int = 7) -> DataFrame:
    """Hierarchy edges: parent = c_custkey div fanout, child = c_custkey (root 0 has a self loop)."""
    return customer.select(F.expr(f"c_custkey div {fanout}").alias("parent"), F.col("c_custkey").alias("child"))


def _report_row(role: Column, turn: Column, conv: Column) -> Column:
    return F.concat_ws(" | ", role, turn.cast("string"), conv.cast("string"), F.lit("x"))


def _report_lines(conversations: DataFrame, generated: Column) -> DataFrame:
    """Report lines (conv_id, turn, sub, line) from generated (sub, line) pairs per conversation row; the
    report of a conversation is its lines in (turn, sub) order. Nothing is collected per conversation."""
    lines = conversations.select("conv_id", "turn", F.inline(generated))
    return lines.where(F.col("line").isNotNull())


def marked_report_lines(conversations: DataFrame) -> DataFrame:
    """Report lines with part markers: part 1 holds turns 0-1, part 2 starts at turn 2."""
    row = _report_row(F.col("role"), F.col("turn"), F.col("conv_id"))
    t = F.col("turn")
    gen = F.array(
        F.struct(F.lit(0).alias("sub"), F.when(t == 0, F.lit("Start Part 1")).when(t == 2, F.lit("Start Part 2"))
                 .alias("line")),
        F.struct(F.lit(1).alias("sub"), row.alias("line")),
        F.struct(F.lit(2).alias("sub"), F.when(t == 1, F.lit("End Part 1")).alias("line")),
    )
    return _report_lines(conversations, gen)


def two_part_report_lines(conversations: DataFrame) -> DataFrame:
    """The same rows with one ``PART 2`` line before turn 2 instead of markers."""
    row = _report_row(F.col("role"), F.col("turn"), F.col("conv_id"))
    gen = F.array(
        F.struct(F.lit(0).alias("sub"), F.when(F.col("turn") == 2, F.lit("PART 2")).alias("line")),
        F.struct(F.lit(1).alias("sub"), row.alias("line")),
    )
    return _report_lines(conversations, gen)


def vector_texts(embeddings: DataFrame) -> DataFrame:
    """Vectors as comma text: every 10th vec_id has one element "x", every 11th is null, every 13th is
    cut to one element less."""
    elems = F.transform("embedding", lambda x: x.cast("string"))
    elems = F.when(F.col("vec_id") % 10 == 0,
                   F.transform(elems, lambda x, i: F.when(i == 4, F.lit("x")).otherwise(x))).otherwise(elems)
    elems = F.when(F.col("vec_id") % 13 == 0, F.slice(elems, 1, F.size(elems) - 1)).otherwise(elems)
    text = F.when(F.col("vec_id") % 11 == 0, F.lit(None).cast("string")).otherwise(F.array_join(elems, ","))
    return embeddings.select("vec_id", text.alias("vector_text"))


def cut_vectors(embeddings: DataFrame) -> DataFrame:
    """Vectors with every 13th vec_id cut to one element less."""
    v = F.col("embedding")
    return embeddings.select("vec_id", F.when(F.col("vec_id") % 13 == 0, F.slice(v, 1, F.size(v) - 1))
                             .otherwise(v).alias("embedding"))


def text_reports(conversations: DataFrame) -> DataFrame:
    """One report text per conversation row, (conv_id, turn, report), with the lines of the row's text as rows of
    both tables: in part 1 as ``role | line number | conv_id | line``, in part 2 as ``role | line number | line``."""
    lines = F.split("text", "\n", -1)
    row = lambda first: F.transform(lines, lambda x, i: F.concat_ws(" | ", F.col("role"), i.cast("string"), *first, x))
    report = F.concat(F.array(F.lit("Start Part 1")), row([F.col("conv_id").cast("string")]), F.array(F.lit("End Part 1"), F.lit("Start Part 2")),
                      row([]), F.array(F.lit("End Part 2")))
    return conversations.select("conv_id", "turn", F.array_join(report, "\n").alias("report"))


def two_part_reports(conversations: DataFrame) -> DataFrame:
    """One report text per conversation row, (conv_id, turn, report): the lines of the row's whole text as rows of four
    cells, then ``PART 2``, then as rows of three."""
    row = lambda first: F.array_join(F.transform(F.split("text", "\n", -1), lambda x, i: F.concat_ws(" | ", F.col("role"), i.cast("string"), *first, x)), "\n")
    report = F.concat(row([F.col("conv_id").cast("string")]), F.lit("\nPART 2\n"), row([]))
    return conversations.select("conv_id", "turn", report.alias("report"))


def payload_texts(embeddings: DataFrame, parts: int = 4, size: int = 16) -> DataFrame:
    """Stored payload rows: ``vec_id`` and ``parts`` vectors of ``size`` elements as comma text, some of them bad:
    an element "x" (every 10th), null (every 11th), one element short (every 13th), an element "1.0f" (every 17th)."""
    element = F.transform("embedding", lambda x: x.cast("string"))
    out = [F.slice(element, 1 + i * size, size) for i in range(parts)]
    every = lambda n: F.col("vec_id") % n == 0
    spoilt = lambda v, text: F.transform(v, lambda x, i: F.when(i == 4, F.lit(text)).otherwise(x))
    out[0] = F.when(every(10), spoilt(out[0], "x")).otherwise(out[0])
    out[2] = F.when(every(13), F.slice(out[2], 1, size - 1)).otherwise(out[2])
    out[3] = F.when(every(17), spoilt(out[3], "1.0f")).otherwise(out[3])
    texts = [F.array_join(v, ",") for v in out]
    texts[1] = F.when(~every(11), texts[1])
    return embeddings.select("vec_id", *[t.alias(f"v{i + 1}") for i, t in enumerate(texts)])
