"""Parsing reports into tables, and joining rows into report text.

A report is a sequence of lines per document: either a text value split into lines, or line rows
produced directly. The section state (which part a line belongs to) and the split positions are running
aggregates over each document's lines in order. For line rows they are computed with
:func:`lakeops.operators.ordering.with_group_running`, so even a document holding a third of all lines
is spread over many tasks and nothing is collected per document. A text value is one row and so bounded: its lines
need no global sort, only a window over the text, or no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.ordering import with_group_row_number, with_group_running
from lakeops.operators.sizing import broadcast_if_small
from lakeops.session import ensure_checkpoint_dir

# Section markers and separators of the report formats.
START_PART_1 = "Start Part 1"
END_PART_1 = "End Part 1"
START_PART_2 = "Start Part 2"
END_PART_2 = "End Part 2"
MARKERS = (START_PART_1, END_PART_1, START_PART_2, END_PART_2)
PART_2_SPLIT = "PART 2"
CELL_SEP = "|"


def strip(c: Column) -> Column:
    """Remove white space at both ends (like Python's ``str.strip``)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def pipe_cells(line: Column, trim: bool = True) -> Column:
    cells = F.split(line, r"\|", -1)
    return F.transform(cells, strip) if trim else cells


def text_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """One row per line of every text: (doc, line_no, line)."""
    return df.select(doc, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def parse_sections(lines: DataFrame, doc: str, order: Sequence[str], line: str, bounded: bool = False) -> DataFrame:
    """Rows of the two marked parts of each report, from its lines in ``order``.

    Part 1 opens at ``Start Part 1`` (which also closes part 2) and closes at ``End Part 1``; part 2 opens
    at ``Start Part 2`` and closes at ``End Part 2``. A line with a pipe inside an open part is split into
    trimmed cells; part 1 keeps lines of at least 4 cells (the first 4), and otherwise part 2 keeps
    lines of at least 3 cells (the first 3). ``line_no`` is the 0-based position of the line. ``bounded``: the
    lines of a document are those of one text, so that they may meet in one task."""
    ln = strip(F.col(line))
    part1_event = F.when(ln == START_PART_1, True).when(ln == END_PART_1, False)
    part2_event = F.when(ln == START_PART_2, True).when(ln == END_PART_2, False).when(ln == START_PART_1, False)
    staged = lines.select(doc, *order, ln.alias("_line"), part1_event.alias("_e1"), part2_event.alias("_e2"))
    if bounded:
        upto = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = staged.withColumns({"_in1": F.last("_e1", True).over(upto), "_in2": F.last("_e2", True).over(upto),
                                  "_pos": F.count(F.lit(1)).over(upto)})
    else:
        run = with_group_running(staged, [doc], order, [
            ("_in1", "last", F.col("_e1")), ("_in2", "last", F.col("_e2")), ("_pos", "sum", F.lit(1))])
    cells = pipe_cells(F.col("_line"))
    n = F.size(cells)
    in1, in2 = F.coalesce(F.col("_in1"), F.lit(False)), F.coalesce(F.col("_in2"), F.lit(False))
    is_row = ~F.col("_line").isin(*MARKERS) & F.contains(F.col("_line"), F.lit(CELL_SEP))
    part = F.when(is_row & in1 & (n >= 4), F.lit(1)).when(is_row & in2 & (n >= 3), F.lit(2))
    rows = run.select(doc, (F.col("_pos") - 1).alias("line_no"), part.alias("part"), cells.alias("_cells"))
    rows = rows.where(F.col("part").isNotNull())
    return rows.select(
        doc, "line_no", "part",
        *[F.col("_cells")[i].alias(f"c{i + 1}") for i in range(3)],
        F.when(F.col("part") == 1, F.col("_cells")[3]).alias("c4"),
    )


def parse_section_text(df: DataFrame, doc: str, text: str) -> DataFrame:
    """:func:`parse_sections` on report texts (one text for each ``doc``)."""
    return parse_sections(text_lines(df, doc, text), doc, ["line_no"], "line", bounded=True)


def parse_two_parts(lines: DataFrame, doc: str, order: Sequence[str], line: str) -> DataFrame:
    """Rows of a report whose second table follows the first ``PART 2``, from its lines in ``order``.

    The report is cut at the first ``PART 2`` (which may sit inside a line) and again at the second, as a
    text split would: part 1 is everything before the first cut, part 2 everything between the two, the
    rest is not read; no ``PART 2`` means an empty second part. Every piece of a line with a pipe is a
    row, split into untrimmed cells; ``line_no`` counts lines within the part."""
    n_cut = F.size(F.split(F.col(line), PART_2_SPLIT, -1)) - 1
    staged = lines.select(doc, *order, F.col(line).alias("_line"), n_cut.alias("_n"))
    run = with_group_running(staged, [doc], order, [("_cuts", "sum", F.col("_n")), ("_idx", "sum", F.lit(1))])
    # Line index of the first cut per document: an aggregate (one row per document with a cut) joined
    # back. AQE broadcasts it at run time when its shuffle output is small, and otherwise splits the
    # partition of a hot document across tasks.
    firsts = run.where(F.col("_n") > 0).groupBy(F.col(doc).alias("_doc")).agg(F.min("_idx").alias("_first"))
    run = run.join(firsts, F.col(doc).eqNullSafe(F.col("_doc")), "left")
    before = F.col("_cuts") - F.col("_n")
    segs = F.split(F.col("_line"), PART_2_SPLIT, -1)
    piece1 = F.struct(F.lit(1).alias("part"), (F.col("_idx") - 1).alias("line_no"),
                      F.when(before == 0, segs[0]).alias("text"))
    piece2 = F.struct(F.lit(2).alias("part"),
                      F.when(before == 0, F.lit(0).cast("long")).otherwise(F.col("_idx") - F.col("_first")).alias("line_no"),
                      F.when((before == 0) & (F.col("_n") >= 1), F.try_element_at(segs, F.lit(2)))
                      .when(before == 1, segs[0]).alias("text"))
    pieces = run.select(doc, F.inline(F.array(piece1, piece2)))
    pieces = pieces.where(F.col("text").isNotNull() & F.contains(F.col("text"), F.lit(CELL_SEP)))
    return _untrimmed_rows(pieces, doc)


def _untrimmed_rows(pieces: DataFrame, doc: str) -> DataFrame:
    cells = pipe_cells(F.col("text"), trim=False)
    return pieces.select(doc, "part", "line_no", F.col("text").alias("line"), F.size(cells).alias("n_cells"),
                         *[F.try_element_at(cells, F.lit(i + 1)).alias(f"c{i + 1}") for i in range(4)])


def parse_two_part_text(df: DataFrame, doc: str, text: str) -> DataFrame:
    """:func:`parse_two_parts` on report texts: a text is cut and its parts exploded where it lies, without a shuffle."""
    parts = F.slice(F.split(F.col(text), PART_2_SPLIT, -1), 1, 2)
    cut = df.select(doc, F.posexplode(parts).alias("_at", "_part"))
    lines = cut.select(doc, (F.col("_at") + 1).alias("part"), F.posexplode(F.split("_part", "\n", -1)).alias("_no", "text"))
    return _untrimmed_rows(lines.select(doc, "part", F.col("_no").cast("long").alias("line_no"), "text").where(F.contains("text", F.lit(CELL_SEP))), doc)


def joined_lines(df: DataFrame, group: str, line: Column, chunk_lines: int = 1000, name: str = "text") -> DataFrame:
    """The lines of each group, sorted and joined by newlines, as texts of ``chunk_lines`` lines (the last of a
    group may be shorter), numbered 0, 1, ...: (group, chunk, text). A group of any size becomes bounded
    texts; one that fits is one text and is joined at once. Only the lines of larger groups are numbered (skew-safe):
    these groups are at most one for ``chunk_lines`` rows, and usually few."""
    ensure_checkpoint_dir(df.sparkSession)
    lines = df.select(F.col(group).alias("_g"), line.alias("_line"))
    large = lines.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk_lines).select(F.col("_g").alias("_large")).checkpoint()
    join = lambda rows: (rows.groupBy("_g", "chunk").agg(F.array_join(F.array_sort(F.collect_list("_line")), "\n").alias(name))
                         .withColumnRenamed("_g", group))
    if large.isEmpty():
        return join(lines.withColumn("chunk", F.lit(0).cast("long")))
    side = broadcast_if_small(large)
    same = F.col("_g").eqNullSafe(F.col("_large"))
    numbered = with_group_row_number(lines.join(side, same, "left_semi"), ["_g"], ["_line"], "_rank")
    chunked = numbered.select("_g", "_line", F.floor((F.col("_rank") - 1) / F.lit(chunk_lines)).cast("long").alias("chunk"))
    return join(lines.join(side, same, "left_anti").withColumn("chunk", F.lit(0).cast("long")).unionByName(chunked))
