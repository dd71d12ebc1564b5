"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words of an item (an item of fewer words, but not none, is one window).
For windows of L words every k-gram of k = (L + 1) // 2 words is hashed, and a window's fingerprint is the
smallest of the L - k + 1 hashes inside it. Equal windows have equal fingerprints, so every shared span of
L words is met: that is the guarantee of winnowing. Documents and items are joined on the fingerprint and
a hit is extended to the window by comparing its words.

Plan: the fingerprints of the items make a bit filter of at most 2^27 bits (16 MB, whatever their number),
broadcast to the single pass over the documents. The pass returns, per document, the word count and the
windows whose fingerprint the filter knows; these rows are checkpointed and joined with the items'
distinct windows (broadcast if measured to be under ``broadcast_bytes``, else a shuffle join that adaptive
execution splits at hot windows). Hit words are the union of intervals, found by a running maximum per
document; items are counted from distinct (document, item set) rows, so an item window shared by many
items or found in many documents is expanded only once per document.

Defined cases: null and empty texts have no words; a document shorter than a window cannot hold it; rows
that repeat, even with the same or a null doc_id, are judged row by row; items that repeat count once per
item_id, and an item whose id is null marks words but is not listed; without items nothing is hit; only
the id and text columns are read, so extra columns change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm import textbytes as tb
from lakeops.session import ensure_checkpoint_dir

PIECE_BYTES = 1 << 20
FILTER_BITS = 27


def _grams_of(span: int) -> tuple[int, int]:
    k = (span + 1) // 2
    return k, span - k + 1


def _words(texts: list[str | None]):
    """Lower-cased buffer, word starts and ends, word hashes, and the words per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data, begins = tb.join_texts(raw)
    data = tb.LOWER[data]
    starts, ends = tb.runs(tb.ALNUM[data])
    return data, starts, ends, tb.span_hash(tb.prefix_hash(data), starts, ends), tb.owner_counts(begins, starts)


def _fingerprints(codes: np.ndarray, span: int) -> np.ndarray:
    """Fingerprint of the window of ``span`` words at each word (of one concatenation of texts)."""
    k, width = _grams_of(span)
    return tb.sliding_min(tb.gram_hash(codes, k), width) ^ np.uint64(span)


def _window_text(data: np.ndarray, starts, ends, at: int, span: int) -> str:
    return b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(at, at + span)).decode("utf-8", "replace")


_HIT = pa.struct([("start", pa.int32()), ("span", pa.int32()), ("print", pa.int64()), ("window", pa.string())])


def _item_rows(batches, span: int):
    for batch in batches:
        out = {"item_id": [], "span": [], "print": [], "window": []}
        ids = batch.column(0).to_pylist()
        for lo, hi, texts in tb.text_groups(batch, 1, PIECE_BYTES):
            data, starts, ends, codes, counts = _words(texts)
            first = 0
            for item, n in zip(ids[lo:hi], counts.tolist()):
                if n:
                    size = min(span, n)
                    prints = _fingerprints(codes[first:first + n], size).view(np.int64).tolist()
                    for j, value in enumerate(prints):
                        out["item_id"].append(None if item is None else str(item))
                        out["span"].append(size)
                        out["print"].append(value)
                        out["window"].append(_window_text(data, starts, ends, first + j, size))
                first += n
        yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.string()), pa.array(out["span"], pa.int32()),
                                          pa.array(out["print"], pa.int64()), pa.array(out["window"], pa.string())], list(out))


def _pack_chunks(batches):
    for batch in batches:
        chunks = []
        for bits in batch.column(1).to_pylist():
            mask = np.zeros(1 << 16, np.uint8)
            mask[bits] = 1
            chunks.append(np.packbits(mask).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chunks, pa.binary())], ["chunk", "bits"])


def _filter(prints: DataFrame) -> tuple[int, np.ndarray]:
    """(shift, bit array): bit ``print >> shift`` is set for every fingerprint."""
    n = prints.count()
    bits = min(FILTER_BITS, max(16, int(n).bit_length() + 5))
    bucket = F.shiftrightunsigned("print", 64 - bits)
    chunks = (prints.select(bucket.alias("b")).distinct()
              .groupBy(F.shiftright("b", 16).alias("chunk"))
              .agg(F.collect_list((F.col("b") % (1 << 16)).cast("int")).alias("bits"))
              .mapInArrow(_pack_chunks, "chunk long, bits binary").collect())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in chunks:
        out[row.chunk << 13:(row.chunk + 1) << 13] = np.frombuffer(row.bits, np.uint8)
    return 64 - bits, out


def _doc_rows(batches, spans: list[int], shared):
    shift, bitmap = shared.value
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, texts in tb.text_groups(batch, 1, PIECE_BYTES):
            data, starts, ends, codes, counts = _words(texts)
            firsts = np.r_[0, np.cumsum(counts)]
            last = np.repeat(firsts[1:], counts)  # end, in words, of the text each word is in
            found: list[list[dict]] = [[] for _ in range(hi - lo)]
            for span in spans:
                prints = _fingerprints(codes, span)
                bucket = prints >> np.uint64(shift)
                known = (bitmap[bucket >> np.uint64(3)] >> (np.uint8(7) - (bucket & np.uint64(7)).astype(np.uint8))) & 1
                at = np.flatnonzero(known)
                at = at[at + span <= last[at]]
                text = np.searchsorted(firsts, at, side="right") - 1
                for p, t, value in zip(at.tolist(), text.tolist(), prints[at].view(np.int64).tolist()):
                    found[t].append({"start": p - int(firsts[t]), "span": span, "print": value,
                                     "window": _window_text(data, starts, ends, p, span)})
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_HIT))],
                                             ["doc_id", "n_words", "found"])


def find_leaks(documents: DataFrame, items: DataFrame, span: int = 10, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``documents``: its id, n_words, n_hit, items (sorted ids as strings), and ``hits``: every
    window hit, as (start, stop) in words."""
    if not 1 <= span <= 64:
        raise ValueError("span must be 1 to 64 words")
    spark = documents.sparkSession
    ensure_checkpoint_dir(spark)
    windows = (items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
               .mapInArrow(lambda b: _item_rows(b, span), "item_id string, span int, print long, window string")
               .groupBy("print", "span", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
               .checkpoint())
    spans = sorted(r.span for r in windows.select("span").distinct().collect())  # at most ``span`` values
    shared = spark.sparkContext.broadcast(_filter(windows.select("print").distinct()))
    id_type = documents.schema[doc_id].dataType.simpleString()
    rows = (documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(lambda b: _doc_rows(b, spans, shared),
                        f"doc_id {id_type}, n_words long, found array<struct<start:int,span:int,print:long,window:string>>")
            .checkpoint().withColumn("row", F.monotonically_increasing_id()))
    size = windows.agg(F.sum(F.length("window") + 32 + 8 * F.size("items")).alias("b")).first().b or 0
    side = F.broadcast(windows) if size <= broadcast_bytes else windows
    hits = (rows.where(F.size("found") > 0).select("row", F.inline("found"))
            .join(side, ["print", "span", "window"]).select("row", "start", (F.col("start") + F.col("span")).alias("stop"), "items"))
    by_row = Window.partitionBy("row").orderBy("start", "stop")
    before = F.coalesce(F.max("stop").over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans_of = (hits.select("row", "start", "stop").distinct().withColumn("before", before)
                .withColumn("first", F.greatest("start", "before"))
                .groupBy("row").agg(F.sum(F.greatest(F.col("stop") - F.col("first"), F.lit(0))).alias("n_hit"),
                                    F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("hits")))
    items_of = (hits.select("row", "items").distinct().select("row", F.explode("items").alias("item"))
                .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    return (rows.drop("found").join(spans_of, "row", "left").join(items_of, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("hits", F.array().cast("array<struct<start:int,stop:int>>")).alias("hits")))
