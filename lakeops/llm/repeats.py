"""Removal of repeated passages with longest-previous-factor arrays over suffix order.

A byte goes if it is covered by a string of ``length`` bytes that also starts in a document with a smaller id.
At each position the longest previous factor (LPF) is the longest string that also starts there and in an
earlier document; it is found from the nearest entries before and after it, in suffix order, that belong to
an earlier document (previous and next smaller values). Only "LPF >= length" matters here, so suffixes are
compared on their first ``length`` bytes, and are sorted in parts:

1. Documents are packed in blocks. The partition key of a suffix is the smallest hash of the ``GRAM``-byte
   strings inside its first ``length`` bytes: equal strings have equal keys, and neighbouring suffixes
   mostly share a key, so a run of them is one entry. Each block sends its distinct keys to buckets, with the
   power of two that holds the suffixes of the key's distinct runs; a bucket answers which keys occur in at
   least two documents, and which are hot: more than ``SORT_AT_ONCE`` suffixes by the sum of those powers.
2. A suffix with a hot key gets another key, the hash of its whole ``length`` bytes, and is a run of its own.
   Blocks exchange these keys as in step 1 (only if there are any), so a string of one document goes no further.
3. For the keys left each block sends its distinct runs, with the smallest document of each, to the key's
   bucket. The bucket puts the suffixes in order, in pieces of whole keys, and computes their longest-previous-factor
   array from the previous and next smaller positions and the common prefixes between: an entry whose value is below
   ``length`` is of the first document that has its string, and the other entries equal to it follow that document.
4. Each block gets the answers back, marks the bytes, and returns what remains.

A passage in a third of all documents is one entry per block, so no bucket grows with a group of copies. A
string of ``GRAM`` bytes that a third of all documents hold in different surroundings is a hot key, whose
suffixes are spread over all buckets; so no group and no sort depends on one such string.
Long texts are hashed in pieces. Every step is stored and can be repeated.

Defined cases: a null text has no bytes; a text shorter than ``length`` loses none; rows with the same id do
not remove each other's bytes; a row with a null id counts as later than all and earlier than none; matches
never cross rows; other columns pass through; empty tables give empty results. Equal ``GRAM`` and run hashes
(64 bits) only choose what is compared or merged within a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm import blocks as bl
from lakeops.llm import textbytes as tb

GRAM = 20
#: Blocks here are larger than elsewhere: a passage is sent once per block, and messages are fewer.
BLOCK_SCALE = 2
PIECE = 1 << 20
SORT_AT_ONCE = 200_000
KEY_BITS = 48
NO_ID = np.iinfo(np.int64).max


class _Texts:
    """The texts of one block in one buffer, with each row's begin, end and id."""

    def __init__(self, payload: bytes, text: int, doc_id: int):
        self.batch = bl.from_bytes(payload)
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in self.batch.column(text).to_pylist()]
        self.data, self.begin = tb.join_texts(raw, b"\0")
        sizes = np.array([len(t) for t in raw], np.int64)
        del raw
        self.end = self.begin + sizes
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
        ids = self.batch.column(doc_id)
        self.ids = np.array([NO_ID if i is None else i for i in ids.to_pylist()], np.int64)

    def runs(self, length: int, gram: int):
        """Per piece: (start, stop, key, row) of runs of suffixes with one key, and the piece's prefix hashes
        with their offset."""
        total, width = len(self.data), length - gram + 1
        for lo in range(0, total, PIECE):
            part = self.data[lo:lo + PIECE + length - 1]
            if len(part) < length:
                return
            prefix = tb.prefix_hash(part)
            keys = tb.sliding_min(tb.rolling_hash(prefix, gram), width)
            row = self.row[lo:lo + len(keys)]
            inside = np.arange(lo + length, lo + length + len(keys)) <= self.end[row]
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])])
            stop = np.r_[first[1:], len(keys)]
            ok = inside[first]
            first, stop = first[ok], stop[ok]
            # Minima crowd at small values; scrambled, they fill the buckets evenly.
            yield first + lo, stop + lo, tb.mix(keys[first]) >> np.uint64(64 - KEY_BITS), row[first], prefix, lo


def _scatter_keys(batches, text, doc_id, length, gram, buckets):
    for block, payload in bl.rows_of(batches):
        texts = _Texts(payload, text, doc_id)
        found = [(key, texts.ids[row], _content(prefix, lo, first, stop, length), stop - first)
                 for first, stop, key, row, prefix, lo in texts.runs(length, gram)]
        if not found:
            continue
        key, ids, content, size = (np.concatenate(x) for x in zip(*found))
        del found
        order = np.lexsort((content, key))
        key, ids, content, size = key[order], ids[order], content[order], size[order]
        size[1:][(content[1:] == content[:-1]) & (key[1:] == key[:-1])] = 0  # equal runs will be sent once
        yield from _send_keys(block, key, ids, size, buckets)


def _scatter_hot(batches, text, doc_id, length, gram, buckets):
    for block, payload, answers in bl.rows_of(batches):
        texts = _Texts(payload, text, doc_id)
        keys, hot = _answered(answers)
        found = [(key, texts.ids[row]) for _, key, row, _ in _hot_strings(texts, keys[hot], length, gram)]
        if found:
            key, ids = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(key, kind="stable")
            yield from _send_keys(block, key[order], ids[order], np.ones(len(key), np.int64), buckets)


def _content(prefix, lo, first, stop, length):
    return tb.span_hash(prefix, first - lo, stop - lo + length - 1) + tb.mix((stop - first).astype(np.uint64))


def _send_keys(block, key, ids, size, buckets):
    """The distinct ones of sorted keys, by bucket: whether a key has two documents, and a power of two of its sizes."""
    if not len(key):
        return
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
    power = np.ceil(np.log2(np.add.reduceat(size, first))).astype(np.uint8)
    key = key[first]
    yield from _by_bucket(block, key, buckets, lambda lo, hi: bl.columns_to_bytes(
        key=bl.pack_sorted(key[lo:hi]), several=np.packbits(several[lo:hi]), power=power[lo:hi]))


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


def _by_bucket(block: int, key: np.ndarray, buckets: int, payload):
    """(bucket, block, payload) for every bucket of the sorted keys."""
    of = _bucket_of(key, buckets)
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    for lo, hi in zip(cuts.tolist(), np.r_[cuts[1:], len(of)].tolist()):
        yield pa.RecordBatch.from_arrays([pa.array([int(of[lo])], pa.int64()), pa.array([block], pa.int64()),
                                          pa.array([payload(lo, hi)], pa.binary())], ["bucket", "block", "payload"])


_ANSWER = pa.schema([("block", pa.int64()), ("payload", pa.binary())])
_KEYS = _ANSWER.append(pa.field("hot", pa.bool_()))


def _shared_keys(table: pa.Table, at_once: int) -> pa.Table:
    """Of one bucket: tells each block which of its keys are in two documents at least, and which of these are hot."""
    sent = [bl.columns_from_bytes(p) for p in table.column("payload").to_pylist()]
    keys = [bl.unpack_sorted(x["key"]) for x in sent]
    several = [np.unpackbits(x["several"], count=len(k)).astype(bool) for x, k in zip(sent, keys)]
    distinct, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = n > 1
    shared[at[np.concatenate(several)]] = True
    hot = shared & (np.bincount(at, np.exp2(np.concatenate([x["power"] for x in sent]).astype(np.float64))) > at_once)
    out, any_hot, begin = [], [], 0
    for k in keys:
        mine = at[begin:begin + len(k)]
        told = shared[mine]
        out.append(bl.columns_to_bytes(key=bl.pack_sorted(k[told]), hot=np.packbits(hot[mine][told])))
        any_hot.append(bool(hot[mine].any()))
        begin += len(k)
    return pa.Table.from_arrays([table.column("block"), pa.array(out, pa.binary()), pa.array(any_hot, pa.bool_())], schema=_KEYS)


def _answered(answers: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The shared keys of a block in order, and which of them are hot."""
    told = [bl.columns_from_bytes(a) for a in answers or []]
    keys = [bl.unpack_sorted(x["key"]) for x in told]
    hot = [np.unpackbits(x["hot"], count=len(k)).astype(bool) for x, k in zip(told, keys)]
    key = np.concatenate([np.empty(0, np.uint64), *keys])
    order = np.argsort(key, kind="stable")
    return key[order], np.concatenate([np.empty(0, bool), *hot])[order]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Where ``values`` are in ``ordered``."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values)


def _hot_strings(texts: _Texts, hot: np.ndarray, length: int, gram: int):
    """Per piece: (start, key, row, content) of every suffix with a hot key; the key is of its first ``length`` bytes."""
    if not len(hot):
        return
    for first, stop, key, row, prefix, lo in texts.runs(length, gram):
        hit = _among(key, hot)
        size = (stop - first)[hit]
        if not len(size):
            continue
        at = np.repeat(first[hit] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        content = _content(prefix, lo, at, at + 1, length)
        yield at, tb.mix(content) >> np.uint64(64 - KEY_BITS), np.repeat(row[hit], size), content


class _SharedRuns:
    """The runs of a block whose keys are shared: distinct runs by content, and every place they occur."""

    def __init__(self, texts: _Texts, answers: list[bytes], strings: list[bytes], length: int, gram: int):
        shared, hot = _answered(answers)
        parts = []
        for first, stop, key, row, prefix, lo in texts.runs(length, gram):
            hit = _among(key, shared[~hot])
            first, stop, key, row = first[hit], stop[hit], key[hit], row[hit]
            parts.append((first, stop, key, row, _content(prefix, lo, first, stop, length)))
        common, _ = _answered(strings)
        for first, key, row, content in _hot_strings(texts, shared[hot], length, gram):
            hit = _among(key, common)
            parts.append((first[hit], first[hit] + 1, key[hit], row[hit], content[hit]))
        self.first, self.stop, key, row, content = (np.concatenate(x) if parts else np.empty(0, np.int64) for x in (zip(*parts) if parts else [()] * 5))
        self.ids = texts.ids[row.astype(np.int64)] if len(row) else np.empty(0, np.int64)
        # Sorted by (key, content): the distinct runs stand in key order.
        order = np.lexsort((content, key))
        change = np.r_[True, (content[order][1:] != content[order][:-1]) | (key[order][1:] != key[order][:-1])][:len(order)]
        heads = np.flatnonzero(change)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(change) - 1
        pick = order[heads]
        self.key, self.at, self.n = key[pick], self.first[pick], (self.stop - self.first)[pick]
        self.low = np.minimum.reduceat(self.ids[order], heads) if len(heads) else np.empty(0, np.int64)
        high = np.maximum.reduceat(self.ids[order], heads) if len(heads) else np.empty(0, np.int64)
        self.several = self.low != high


def _scatter_runs(batches, text, doc_id, length, gram, buckets):
    for block, payload, keys, strings in bl.rows_of(batches):
        texts = _Texts(payload, text, doc_id)
        runs = _SharedRuns(texts, keys, strings, length, gram)
        if not len(runs.key):
            continue

        def rows(lo, hi, runs=runs, texts=texts):
            bytes_of = np.concatenate([texts.data[a:a + n + length - 1] for a, n in zip(runs.at[lo:hi].tolist(), runs.n[lo:hi].tolist())])
            return bl.columns_to_bytes(key=bl.pack_sorted(runs.key[lo:hi]), n=runs.n[lo:hi].astype(np.int32),
                                       low=runs.low[lo:hi], several=np.packbits(runs.several[lo:hi]), data=bytes_of,
                                       lo=np.array([lo], np.int64))

        yield from _by_bucket(block, runs.key, buckets, rows)


def suffix_order(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of equal-length byte strings, and how many bytes each has in common with the one before it in
    that order (0 for the first)."""
    width = suffixes.shape[1]
    padded = np.empty((len(suffixes), width + 1), np.uint8)
    padded[:, :width] = suffixes
    padded[:, width] = 1  # numpy drops trailing zero bytes of strings
    order = np.argsort(padded.view(f"S{width + 1}").ravel(), kind="stable")
    placed = suffixes[order]
    differ = placed[1:] != placed[:-1]
    common = np.zeros(len(order), np.int32)
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def _nearest_smaller(ids: np.ndarray, common: np.ndarray, enough: int) -> np.ndarray:
    """For every entry, what it has in common with the nearest entry before it that has a smaller id (0: there is none).
    An entry looks at its neighbour; while that one's id is not smaller it goes on to the one its neighbour has come to,
    so steps double. It stops where less than ``enough`` is left, with what is left."""
    at, left = np.arange(-1, len(ids) - 1), common.copy()
    going = np.arange(len(ids))
    while True:
        going = going[(at[going] >= 0) & (left[going] >= max(1, enough))]
        going = going[ids[at[going]] >= ids[going]]
        if not len(going):
            break
        there = at[going]
        left[going], at[going] = np.minimum(left[going], left[there]), at[there]
    left[at < 0] = 0
    return left


def longest_previous_factors(ids: np.ndarray, common: np.ndarray, enough: int = 0) -> np.ndarray:
    """The longest-previous-factor array in suffix order, capped at the compared bytes: for every entry the longest
    prefix that an entry with a smaller id has too. Of all entries with smaller ids the nearest one before and the
    nearest one after it have most in common with it. Values below ``enough`` may be larger than the true ones (but
    not than ``enough``)."""
    before = _nearest_smaller(ids, common, enough)
    after = _nearest_smaller(ids[::-1], np.r_[0, common[:0:-1]].astype(common.dtype), enough)[::-1] if len(ids) else before
    return np.maximum(before, after)


def first_documents(suffixes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For rows of equal-length byte strings: the smallest id among equal rows. An entry whose longest previous factor
    does not reach the whole length is of the first document that has its string; all others equal to it follow that
    document."""
    width = suffixes.shape[1]
    order, common = suffix_order(suffixes)
    placed = ids[order]
    firsts = np.flatnonzero(longest_previous_factors(placed, common, width) < width)
    string = np.cumsum(common < width) - 1
    owner = np.empty(int(string[-1]) + 1 if len(string) else 0, np.int64)
    owner[string[firsts]] = placed[firsts]
    out = np.empty(len(ids), np.int64)
    out[order] = owner[string]
    return out


def _suffix_order(table: pa.Table, length: int) -> pa.Table:
    """Of one bucket: the first document of every suffix of every run sent, where it changes anything."""
    sent = [bl.columns_from_bytes(p) for p in table.column("payload").to_pylist()]
    key = np.concatenate([bl.unpack_sorted(x["key"]) for x in sent])
    n = np.concatenate([x["n"] for x in sent]).astype(np.int64)
    low = np.concatenate([x["low"] for x in sent])
    data = np.concatenate([x["data"] for x in sent])
    several = np.concatenate([np.unpackbits(x["several"], count=len(x["n"])).astype(bool) for x in sent])
    begin = np.cumsum(n + length - 1) - (n + length - 1)
    place = np.cumsum(n) - n
    firsts = np.empty(int(n.sum()), np.int64)
    order = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.r_[key[order][1:] != key[order][:-1], True]) + 1  # whole keys only
    sizes = np.add.reduceat(n[order], np.r_[0, ends[:-1]])
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    for a, b in tb.groups(sizes.tolist(), SORT_AT_ONCE):
        chunk = order[(0 if a == 0 else ends[a - 1]):ends[b - 1]]
        inner = np.arange(int(n[chunk].sum())) - np.repeat(np.cumsum(n[chunk]) - n[chunk], n[chunk])
        firsts[np.repeat(place[chunk], n[chunk]) + inner] = first_documents(
            windows[np.repeat(begin[chunk], n[chunk]) + inner], np.repeat(low[chunk], n[chunk]))
    earlier = np.logical_or.reduceat(firsts < np.repeat(low, n), place)
    tell = earlier | several
    out, run = [], 0
    for x in sent:
        m = len(x["n"])
        which = np.flatnonzero(tell[run:run + m])
        sizes = n[run + which]
        at = np.repeat(place[run + which], sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out.append(bl.columns_to_bytes(run=which + int(x["lo"][0]), n=sizes, first=firsts[at]) if len(which) else None)
        run += m
    keep = [i for i, p in enumerate(out) if p is not None]
    blocks = table.column("block").to_pylist()
    return pa.Table.from_arrays([pa.array([blocks[i] for i in keep], pa.int64()), pa.array([out[i] for i in keep], pa.binary())], schema=_ANSWER)


def _cut(batches, text, doc_id, length, gram):
    for _, payload, keys, strings, firsts in bl.rows_of(batches):
        texts = _Texts(payload, text, doc_id)
        cover = np.zeros(len(texts.data) + 1, np.int8)  # changes of the number of strings that cover a byte
        if firsts:
            runs = _SharedRuns(texts, keys, strings, length, gram)
            told = [bl.columns_from_bytes(p) for p in firsts]
            run = np.concatenate([x["run"] for x in told])
            n = np.concatenate([x["n"] for x in told]).astype(np.int64)
            first = np.concatenate([x["first"] for x in told])
            place = np.full(len(runs.key), -1, np.int64)
            place[run] = np.cumsum(n) - n
            for lo in range(0, len(runs.which), 50_000):
                part = np.arange(lo, min(lo + 50_000, len(runs.which)))
                part = part[place[runs.which[part]] >= 0]
                size = runs.n[runs.which[part]]
                inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                gone = first[np.repeat(place[runs.which[part]], size) + inner] < np.repeat(runs.ids[part], size)
                at = (np.repeat(runs.first[part], size) + inner)[gone]
                cover[at] += 1  # a position is the start of one suffix, so indices do not repeat
                cover[at + length] -= 1
        removed = np.cumsum(cover, dtype=np.int32)[:-1] > 0
        yield from _kept(texts, removed)
        del texts, cover, removed


def _kept(texts: _Texts, removed: np.ndarray):
    for lo in range(0, texts.batch.num_rows, 512):
        part = texts.batch.slice(lo, 512)
        kept, spans = [], []
        for b, e in zip(texts.begin[lo:lo + 512].tolist(), texts.end[lo:lo + 512].tolist()):
            gone = removed[b:e]
            starts, stops = tb.runs(gone)
            spans.append([{"start": s, "stop": t} for s, t in zip(starts.tolist(), stops.tolist())])
            kept.append(texts.data[b:e][~gone].tobytes() if len(starts) else texts.data[b:e].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array((texts.end - texts.begin)[lo:lo + 512]),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
            [*part.schema.names, "n_bytes", "spans", "kept"])


def kept_text(kept):
    """The remaining bytes as text, without characters that were cut in part (a pandas UDF: SQL has no lenient decoder)."""
    from pyspark.sql.functions import pandas_udf

    return pandas_udf(_decode, "string")(kept)


def _decode(kept: pd.Series) -> pd.Series:
    return kept.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def remove_repeats(df: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM,
                   at_once: int = SORT_AT_ONCE) -> DataFrame:
    """``df`` with n_bytes, spans (removed byte ranges as start, stop) and kept (the remaining bytes). A key with more
    than ``at_once`` suffixes is hot."""
    if {"n_bytes", "spans", "kept"} & set(df.columns):
        raise ValueError("columns named n_bytes, spans or kept would clash with the result")
    if not isinstance(df.schema[doc_id].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        raise ValueError("documents are ordered by an integer id")
    if length < 2:
        raise ValueError("length must be at least 2 bytes")
    gram = min(gram, length)
    at, who = df.columns.index(text), df.columns.index(doc_id)
    store = bl.Store(df.sparkSession)
    blocks = bl.pack(df, text, store.keep, scale=BLOCK_SCALE)
    buckets = bl.bucket_count(blocks)
    sent = "bucket long, block long, payload binary"
    answer = "block long, payload binary"
    told = "block long, payload binary, hot boolean"
    keys = store.keep(blocks.mapInArrow(lambda b: _scatter_keys(b, at, who, length, gram, buckets), sent)
                      .groupBy("bucket").applyInArrow(lambda t: _shared_keys(t, at_once), told))
    known = bl.replies(blocks, keys).withColumnRenamed("answers", "keys")
    with_hot = keys.where("hot").select("block").distinct()
    if with_hot.isEmpty():
        known = known.withColumn("strings", F.lit(None).cast("array<binary>"))
    else:
        strings = store.keep(known.join(with_hot, "block", "left_semi").select("block", "payload", "keys")
                             .mapInArrow(lambda b: _scatter_hot(b, at, who, length, gram, buckets), sent)
                             .groupBy("bucket").applyInArrow(lambda t: _shared_keys(t, at_once), told))
        known = bl.replies(known, strings).withColumnRenamed("answers", "strings")
    # Every step is stored, and what it was made from goes, so that messages of two steps are never on disk together.
    known = store.result(known.select("block", "payload", "keys", "strings"))
    runs = store.keep(known.mapInArrow(lambda b: _scatter_runs(b, at, who, length, gram, buckets), sent)
                      .groupBy("bucket").applyInArrow(lambda t: _suffix_order(t, length), answer))
    schema = T.StructType([*df.schema.fields, T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])
    return (bl.replies(known, runs).select("block", "payload", "keys", "strings", "answers")
            .mapInArrow(lambda b: _cut(b, at, who, length, gram), schema))
