"""Chat formatting with typed content parts; DataFrame functions only.

A turn's content is a list of typed parts (text, image, audio, document). A visitor (one ``when`` branch per
type inside ``transform``) flattens them in order: text is escaped, the others become numbered placeholders,
and each attachment is recorded with its number, reference and the count of tokens its placeholder expands to.

Template: ``<|start|>role<|text|>content<|end|>`` per turn. Escaping is reversible: backslashes are doubled,
then each control string gets a backslash after its first character, so no control string of ours or of the
other listed templates survives inside a text. The loss mask is a list of code-point ranges of the formatted
string: the content of assistant turns.

Turns are escaped and measured row by row before the shuffle; one shuffle by conversation numbers the turns
(window) and joins them. One conversation is one output string, so it is one row of one task by definition;
reading back works on its turns, in time linear in its length.

Defined cases: null texts are empty, null roles are empty; rows that repeat are turns of their own; turns of
equal number are ordered by role, then content; a null turn number comes first; null conversation ids form
one conversation; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
#: Control strings of this and of widespread templates.
CONTROL = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Expanded tokens of one unit: an image tile, a second of audio, a document page.
TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units"))).cast(f"array<{PART}>")


def _visit(part: Column, number: Column, tokens: dict[str, int]) -> Column:
    out = F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind in tokens:
        out = out.when(part["kind"] == kind, F.concat(F.lit(f"<|{kind}:"), number.cast("string"), F.lit("|>")))
    return out.otherwise(F.lit(""))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: str = "parts", assistant: str = "assistant", tokens: dict[str, int] | None = None) -> DataFrame:
    """conv_id, formatted, loss (array of start, stop in code points), attachments (number, kind, ref, tokens).

    ``parts`` is an array of (kind, text, ref, units). A part of unknown kind is an empty string."""
    tokens = TOKENS if tokens is None else tokens
    attached = F.filter("parts", lambda p: p["kind"].isin(list(tokens)))
    rows = (turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                         F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")).alias("parts"))
            .withColumn("attached", attached).withColumn("n_attached", F.size("attached")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", F.col("parts").cast("string"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Numbers of placeholders: those of earlier turns, then those before this part in its turn.
    rows = rows.withColumn("pos", F.row_number().over(order)).withColumn(
        "base", F.coalesce(F.sum("n_attached").over(before), F.lit(0)))
    earlier = lambda i: F.size(F.filter(F.slice("parts", 1, i), lambda p: p["kind"].isin(list(tokens))))
    rows = rows.withColumn("content", F.array_join(F.transform("parts", lambda p, i: _visit(p, F.col("base") + earlier(i), tokens)), ""))
    head = F.concat(F.lit(START), escape("role"), F.lit(TEXT))
    rows = (rows.withColumn("segment", F.concat(head, F.col("content"), F.lit(END)))
            .withColumn("offset", F.coalesce(F.sum(F.char_length("segment").cast("long")).over(before), F.lit(0)))
            .withColumn("from", F.col("offset") + F.char_length(head))
            .withColumn("loss", F.when(F.col("role") == assistant, F.struct(
                F.col("from").alias("start"), (F.col("from") + F.char_length("content")).alias("stop")))))
    expand = lambda p, i: F.struct((F.col("base") + i).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                                   _expanded(p, tokens).alias("tokens"))
    rows = rows.withColumn("attached", F.transform("attached", expand))
    turn_of = F.struct("pos", "segment", "loss", "attached")
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn_of)).alias("t"))
            .select("conv_id", F.array_join(F.col("t.segment"), "").alias("formatted"),
                    F.filter(F.col("t.loss"), lambda s: s.isNotNull()).alias("loss"),
                    F.flatten(F.col("t.attached")).alias("attachments")))


def _expanded(part: Column, tokens: dict[str, int]) -> Column:
    out = F.lit(0)
    for kind, n in tokens.items():
        out = F.when(part["kind"] == kind, F.coalesce(part["units"], F.lit(1)) * n).otherwise(out)
    return out.cast("long")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and learned (array of the texts under the loss mask), from the
    formatted string and its mask alone; placeholders stay as they are.

    The mask is laid over the string range by range: the string is cut at END, and as a range never crosses
    an END, the k-th range lies in the segment that holds its start; both lists are in order, so segment ends
    (a running sum) are matched by one sorted merge of rows."""
    cut = formatted.withColumn("segments", F.filter(F.split("formatted", r"(?<=\Q" + END + r"\E)"), lambda s: s != ""))
    inner = lambda s: F.substring(s, F.lit(len(START) + 1), F.char_length(s) - len(START) - len(END))
    parts = F.transform("segments", lambda s: F.split(inner(s), r"\Q" + TEXT + r"\E", 2))
    turns = F.transform(parts, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))
    pieces = cut.select("conv_id", F.posexplode("segments").alias("pos", "segment"))
    order = Window.partitionBy("conv_id").orderBy("pos")
    pieces = pieces.withColumn("offset", F.sum(F.char_length("segment").cast("long")).over(order) - F.char_length("segment"))
    ranges = formatted.select("conv_id", F.explode("loss").alias("r")).select("conv_id", "r.start", "r.stop")
    events = (pieces.select("conv_id", F.col("offset").alias("at"), F.lit(0).alias("what"), "segment", F.lit(None).cast("long").alias("stop"))
              .unionByName(ranges.select("conv_id", F.col("start").alias("at"), F.lit(1).alias("what"),
                                         F.lit(None).cast("string").alias("segment"), "stop")))
    line = Window.partitionBy("conv_id").orderBy("at", "what").rowsBetween(Window.unboundedPreceding, 0)
    held = (events.withColumn("of", F.last(F.when(F.col("what") == 0, F.struct("at", "segment")), True).over(line))
            .where("what = 1"))
    masked = F.substring(F.col("of.segment"), (F.col("at") - F.col("of.at") + 1).cast("int"), (F.col("stop") - F.col("at")).cast("int"))
    learned = (held.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", unescape(masked).alias("text")))).alias("l"))
               .select(F.col("conv_id").alias("c"), F.col("l.text").alias("learned")))
    return (cut.withColumn("turns", turns).drop("segments")
            .join(learned, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
            .withColumn("learned", F.coalesce("learned", F.array().cast("array<string>"))))
