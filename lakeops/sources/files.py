"""File sources and sinks: CSV (all text), XML reports, JSON pages, text objects, object listings.

Every reader takes an explicit schema or reads text, so no job scans its input twice to infer types,
and every writer goes to a path the caller names (on a cluster: a shared folder).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.lookup import lookup_join
from lakeops.session import ensure_checkpoint_dir
from lakeops.functions.text import DEFAULT_MAX_LENGTH, LONG_CELL_VALUE, replace_long, round_money

# CSV options that keep every cell exactly as written: quotes escaped by doubling, white space kept.
# A file whose cells hold line breaks is one task to read (``multiline=True``). Files written here can be split:
# line breaks inside cells are written as \\n and \\r, and backslashes as \\b (``escaped_breaks``).
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_BREAKS = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))

# Element and attribute names of the position report.
POSITION_TAG = "OpenPosition"
POSITION_ATTRIBUTES = ("symbol", "position", "markPrice", "positionValue", "fifoPnlUnrealized")


def _escape_breaks(c: Column) -> Column:
    for plain, code in _BREAKS:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _unescape_breaks(c: Column) -> Column:
    for plain, code in reversed(_BREAKS):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  multiline: bool = False, escaped_breaks: bool = False) -> DataFrame:
    """CSV with a header, every column as text (never inferred). With ``columns`` the schema is given and
    the header is only skipped. Files are split into tasks unless ``multiline``."""
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multiline).lower())
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    rows = reader.csv(path)
    if not escaped_breaks:
        return rows
    return rows.select(*[_unescape_breaks(F.col(f"`{c}`")).alias(c) for c in rows.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", escaped_breaks: bool = False) -> None:
    if escaped_breaks:
        df = df.select(*[(_escape_breaks(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`"))
                         .alias(f.name) for f in df.schema.fields])
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def replace_long_entries(spark: SparkSession, input_path: str, output_path: str, column: str,
                         max_length: int = DEFAULT_MAX_LENGTH, multiline: bool = False,
                         escaped_breaks: bool = False) -> DataFrame:
    """Read a CSV, replace cells of ``column`` longer than ``max_length`` by "0", write the CSV with the
    same header. Returns the written rows (read back). ``multiline``: cells hold line breaks, so that a file
    is one task; ``escaped_breaks``: they are escaped, so that files are split."""
    df = read_csv_text(spark, input_path, multiline=multiline, escaped_breaks=escaped_breaks)
    if column not in df.columns:
        raise ValueError(f"no column {column!r} among {df.columns}")
    write_csv(df.withColumn(column, replace_long(column, max_length, LONG_CELL_VALUE)), output_path, escaped_breaks=escaped_breaks)
    return read_csv_text(spark, output_path, df.columns, multiline, escaped_breaks)


def write_positions_xml(df: DataFrame, path: str, root_tag: str = "FlexStatement") -> None:
    """Write rows as ``<OpenPosition attr="..."/>`` elements; columns named like the attributes, null
    attributes left out."""
    attrs = [F.col(c).cast("string").alias(f"_{c}") for c in df.columns if c in POSITION_ATTRIBUTES]
    (df.select(*attrs).write.mode("overwrite").format("xml")
       .option("rootTag", root_tag).option("rowTag", POSITION_TAG).save(path))


# What opens and closes the parts of a document in which markup is no markup.
_OPENS = (("!--", "-->"), ("![CDATA[", "]]>"))


def _markup(spark: SparkSession, path: str) -> DataFrame:
    """(f, b, value): the text after every "<" of the files, with the file and the start of its split, in file order
    inside a split. "<" stands for markup only, in attributes too, so that nothing is cut."""
    return spark.read.option("lineSep", "<").text(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), "value")


def _state_after(piece: str, state: int) -> int:
    """0: markup, 1: inside a comment, 2: inside character data; after ``piece`` if it began in ``state``."""
    for number, (opening, closing) in enumerate(_OPENS, start=1):
        if state == number or (state == 0 and piece.startswith(opening)):
            return 0 if closing in (piece if state else piece[len(opening):]) else number
    return 0


def _may_matter(values: pa.Array) -> np.ndarray:
    """Pieces that can change the state."""
    found = [pc.starts_with(values, o) for o, _ in _OPENS] + [pc.match_substring(values, c) for _, c in _OPENS]
    return reduce(pc.or_, found).to_numpy(zero_copy_only=False)


def _by_split(batch):
    """(file, split, first row, last row + 1) of each stretch of rows of one split."""
    keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    lo = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[lo]:
            yield *keys[lo], lo, i
            lo = i


def _scan_tags(pieces: DataFrame, tag: str) -> DataFrame:
    """Two kinds of rows in one pass: the pieces that open an element ``tag`` (``value``), with the states (bits of
    ``visible``) in which their split may begin so that they are markup, and per split (``value`` null) the state it
    ends in for each state it may begin in (``ends``)."""
    schema = pa.schema([("f", pa.string()), ("b", pa.int64()), ("value", pa.string()), ("visible", pa.int32()), ("ends", pa.list_(pa.int32()))])

    def scanned(batches):
        states: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            values = batch.column(2)
            matters = _may_matter(values)
            visible = np.zeros(len(values), np.int32)
            for f, b, lo, hi in _by_split(batch):
                state, at = states.setdefault((f, b), [0, 1, 2]), lo
                for i in [*(np.flatnonzero(matters[lo:hi]) + lo).tolist(), hi]:
                    visible[at:i + 1 if i < hi else hi] = sum(1 << s for s, now in enumerate(state) if not now)
                    if i < hi:
                        state[:] = [_state_after(values[i].as_py(), now) for now in state]
                    at = i + 1
            keep = pc.and_(pc.match_substring_regex(values, rf"\A{tag}(\s|/|>)"), pa.array(visible > 0))
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values, pa.array(visible), pa.nulls(len(values), pa.list_(pa.int32()))], schema=schema)
            yield rows.filter(keep)
        yield pa.RecordBatch.from_pylist([{"f": f, "b": b, "value": None, "visible": None, "ends": e} for (f, b), e in states.items()], schema)

    return pieces.mapInArrow(scanned, "f string, b long, value string, visible int, ends array<int>")


def _split_starts(scanned: DataFrame) -> DataFrame:
    """(f, b, start): the splits that begin inside a comment or character data, by putting the effects of a file's
    splits (one row each) one after the other."""
    splits = scanned.where(F.col("value").isNull()).groupBy("f").agg(F.array_sort(F.collect_list(F.struct("b", "ends"))).alias("splits"))
    none = F.array().cast("array<struct<b:bigint,start:int>>")
    walked = F.aggregate("splits", F.struct(F.lit(0).alias("now"), none.alias("out")), lambda at, x: F.struct(
        F.element_at(x["ends"], at["now"] + 1).alias("now"),
        F.when(at["now"] == 0, at["out"]).otherwise(F.concat(at["out"], F.array(F.struct(x["b"].alias("b"), at["now"].alias("start"))))).alias("out")))
    return splits.select("f", F.inline(walked["out"]))


def read_positions_xml(spark: SparkSession, path: str, splittable: bool = True) -> DataFrame:
    """Every ``OpenPosition`` element at any depth, its attributes as text columns (missing: null).

    Files are cut at every "<" and read once, so one large file is many tasks. In comments and character data
    elements are text: each split keeps its tags with the states it may begin in for them to be markup, and the
    states of all splits follow from their small effects. The XML parser then reads each tag, so all entities are
    decoded as it does. ``splittable=False`` uses the XML reader, one task a file; both give the same rows."""
    schema = T.StructType([T.StructField(f"_{a}", T.StringType()) for a in POSITION_ATTRIBUTES])
    if splittable:
        attributes = rf"""(?s)\A{POSITION_TAG}((?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*)\s*/?>"""
        ensure_checkpoint_dir(spark)
        scanned = _scan_tags(_markup(spark, path), POSITION_TAG).checkpoint()
        tags = lookup_join(scanned.where(F.col("value").rlike(attributes)), _split_starts(scanned), ["f", "b"], "left")
        tags = tags.where(F.expr("shiftright(visible, coalesce(start, 0)) & 1 = 1"))
        record = F.concat(F.lit(f"<{POSITION_TAG}"), F.regexp_extract("value", attributes, 1), F.lit("/>"))
        raw = tags.select(F.from_xml(record, schema).alias("r")).select("r.*")
    else:
        raw = spark.read.format("xml").option("rowTag", POSITION_TAG).schema(schema).load(path)
    return raw.select(*[F.col(f"_{a}").alias(a) for a in POSITION_ATTRIBUTES])


def position_rows(positions: DataFrame) -> DataFrame:
    """Symbol, quantity as text, and the money attributes rounded to 2 (null stays null)."""
    return positions.select(
        "symbol", F.col("position").alias("qty"),
        round_money("markPrice").alias("price"), round_money("positionValue").alias("value"),
        round_money("fifoPnlUnrealized").alias("pnl_unrealized"),
    )


JOB_FIELDS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("runNum", T.IntegerType()), T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()), T.StructField("retry", T.IntegerType()),
    T.StructField("status", T.StringType()),
])
# Defaults of a missing (or null) job field.
TEXT_DEFAULT = "N/A"
INT_DEFAULT = 0


def parse_job_lists(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``{"jobs": [...]}`` documents to one row per job with the seven fields; a missing or null text
    field is "N/A", a missing or null number is 0."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in JOB_FIELDS.fields])
    raw = T.StructType([T.StructField("jobs", T.ArrayType(as_text))])
    parsed = df.select(*keep, F.from_json(F.col(json_col), raw).alias("_doc"))
    jobs = parsed.select(*keep, F.inline(F.coalesce(F.col("_doc.jobs"), F.array().cast(T.ArrayType(as_text)))))
    out = []
    for f in JOB_FIELDS.fields:
        if isinstance(f.dataType, T.IntegerType):  # numbers may be sent as text or with decimals, which are cut off
            value, default = F.col(f.name).try_cast("double").try_cast("int"), F.lit(INT_DEFAULT)
        else:
            value, default = F.col(f.name), F.lit(TEXT_DEFAULT)
        out.append(F.coalesce(value, default).alias(f.name))
    return jobs.select(*keep, *out)


def job_list_json(jobs: DataFrame, group: Column, order: str) -> DataFrame:
    """Render job rows as ``{"jobs": [...]}`` documents, one per group (null fields are left out). A
    document is one value, so ``group`` must bound its size (e.g. ``id div 100`` over unique ids)."""
    fields = [F.col(f.name) for f in JOB_FIELDS.fields if f.name in jobs.columns]
    docs = jobs.groupBy(group.alias("doc")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*fields).alias("_j")))).alias("_l"))
    return docs.select("doc", F.to_json(F.struct(F.transform("_l", lambda s: s["_j"]).alias("jobs"))).alias("json"))


def write_pages(df: DataFrame, path: str, page: Column) -> None:
    """Land a listing as JSON page files, one folder per page."""
    df.withColumn("page", page).write.mode("overwrite").partitionBy("page").json(path)


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed pages as one DataFrame (the union of the pages, read in one scan)."""
    return spark.read.schema(schema).json(path).drop("page")


def write_text_objects(df: DataFrame, path: str, mode: str = "append", prefix_cols: Sequence[str] = ()) -> None:
    """Write one text column as objects under ``path`` (the writer creates the prefix)."""
    writer = df.write.mode(mode)
    if prefix_cols:
        writer = writer.partitionBy(*prefix_cols)
    writer.text(path)


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Objects under a prefix: path, size, modification time, and prefix (partition) columns. File
    contents are not read: the ``content`` column is pruned."""
    listing = spark.read.format("binaryFile").load(path)
    return listing.select(*[c for c in listing.columns if c != "content"])
