"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut in halves down to leaves of ``leaf_chars`` characters. A leaf is split by the vocabulary's
pattern. Two neighbours are joined by opening the end of the left one and splitting a growing window over
the boundary again, until the window's split meets a split point of the right one (beyond that point both
scans read the same characters, so they agree). Each match of the pattern is encoded the same way: halves,
then a join that re-encodes a growing window of boundary tokens until the pairs at both window edges are
stable. A sequence of tokens is the BPE encoding of its bytes exactly if every neighbouring pair is, so
tokens outside the window can no longer change. Decoding joins byte strings up a tree.

Work is per row: no shuffle, one Arrow batch in memory at a time, any lost task is simply repeated.

Defined cases: a null or empty text has no ids and empty bytes; a very long text is one row of work and
costs time linear in its length; repeated rows are encoded one by one; other columns are passed through
(clashing names raise ``ValueError``); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gc
import heapq
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.blocks import release

#: The pattern of the public vocabulary asks at most this many characters past a match's start or run.
LOOKAHEAD = 3
NAIVE_BYTES = 48
LEAF_BYTES = 24
ROWS_PER_BATCH = 256
NO_RANK = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file at ``path``: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in lines if line.strip())}


class _Cache(dict):
    """Match -> packed ids. A full cache becomes the old one, from which what is asked for again is taken back; both have
    at most ``limit`` entries (results do not depend on it)."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, match: str) -> bytes:
        packed = self.old.get(match)
        if packed is None:
            packed = array("i", self.encode(match.encode("utf-8", "surrogatepass"))).tobytes()
        if len(match) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[match] = packed
        return packed


class ByteBpe:
    """Encoder and decoder for a table of ranks. ``pattern`` must cover every character of a text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = 2048, cache_entries: int = 200_000):
        import regex

        if leaf_chars < 1:
            raise ValueError("leaf_chars must be positive")
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.leaf_chars = leaf_chars
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for tok, rank in ranks.items():
            self.token[rank] = tok
        self.packed = _Cache(self.encode_match, cache_entries)
        self.stable = lru_cache(100_000)(self._stable)

    # -- splitting a text by the pattern ---------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.find(text)
        half = len(text) // 2
        return self.join_matches(self.split(text[:half]), self.split(text[half:]))

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        keep, opened = len(left), 0
        while keep and opened < LOOKAHEAD:  # what ends before the last LOOKAHEAD characters saw its whole context
            keep -= 1
            opened += len(left[keep])
        tail = "".join(left[keep:])
        take = 2
        while True:
            head = right[:take]
            window = tail + "".join(head)
            found = self.find(window)
            if take >= len(right):
                return left[:keep] + found
            starts, at = {}, len(tail)
            for j, match in enumerate(head):
                starts[at] = j
                at += len(match)
            at = 0
            for i, match in enumerate(found):
                if at in starts and at <= len(window) - LOOKAHEAD:
                    return left[:keep] + found[:i] + right[starts[at]:]
                at += len(match)
            take *= 2

    # -- encoding one match ----------------------------------------------------------------------------

    def encode_match(self, piece: bytes) -> list[int]:
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        if len(piece) <= LEAF_BYTES:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join_ids(self.encode_match(piece[:half]), self.encode_match(piece[half:]))

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = self.merge(b"".join(self.token[t] for t in left[len(left) - i:] + right[:j]))
            left_done = i == len(left) or self.stable(left[-i - 1], window[0])
            right_done = j == len(right) or self.stable(window[-1], right[j])
            if left_done and right_done:
                return left[:len(left) - i] + window + right[j:]
            if not left_done:
                i = min(2 * i, len(left))
            if not right_done:
                j = min(2 * j, len(right))

    def _stable(self, a: int, b: int) -> bool:
        return self.merge(self.token[a] + self.token[b]) == [a, b]

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first; a byte without a rank is an error of the vocabulary."""
        return self._merge_short(piece) if len(piece) <= NAIVE_BYTES else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        get = self.ranks.get
        cut = list(range(len(piece) + 1))  # where parts start
        pair_rank = [get(piece[i:i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pair_rank:
            best = min(pair_rank)
            if best == NO_RANK:
                break
            at = pair_rank.index(best)
            del pair_rank[at], cut[at + 1]
            if at < len(pair_rank):
                pair_rank[at] = get(piece[cut[at]:cut[at + 2]], NO_RANK)
            if at:
                pair_rank[at - 1] = get(piece[cut[at - 1]:cut[at + 1]], NO_RANK)
        return [self.ranks[piece[a:b]] for a, b in zip(cut, cut[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends
        prev = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            mid = end[i]
            alive[mid] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if prev[i] >= 0 and (r := get(piece[prev[i]:stop])) is not None:
                heapq.heappush(heap, (r, prev[i], stop))
        return [self.ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    # -- whole texts -----------------------------------------------------------------------------------

    def encode(self, text: str):
        """Ids of ``text`` as a numpy int32 array."""
        import numpy as np

        return np.frombuffer(b"".join(map(self.packed.__getitem__, self.split(text))), dtype="<i4")

    def decode(self, ids) -> bytes:
        parts = list(map(self.token.__getitem__, ids.tolist()))
        while len(parts) > 1:
            parts = [b"".join(parts[i:i + 1024]) for i in range(0, len(parts), 1024)]
        return parts[0] if parts else b""


def _rows(batches, text_at: int, vocab: str, pattern: str, leaf_chars: int):
    bpe = ByteBpe(read_ranks(vocab), pattern, leaf_chars)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_BATCH):
            part = batch.slice(start, ROWS_PER_BATCH)
            ids = [bpe.encode(t or "") for t in part.column(text_at).to_pylist()]
            offsets = [0]
            for x in ids:
                offsets.append(offsets[-1] + len(x))
            import numpy as np

            flat = np.concatenate(ids) if ids else np.empty(0, "<i4")
            columns = [part.column(i) for i in range(part.num_columns) if i != text_at]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))
            columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            names = [n for i, n in enumerate(part.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids", "decoded"])
    del bpe  # the same Python process serves other stages
    gc.collect()  # its caches hold it in a circle
    release()


def encode_decode(df: DataFrame, vocab: str, pattern: str, text: str = "text", leaf_chars: int = 2048) -> DataFrame:
    """``df`` without ``text``, with ``ids`` (array<int>) and ``decoded`` (binary, decoded from the ids).
    ``vocab`` is the path of a rank file that every executor can open."""
    rest = [f for f in df.schema.fields if f.name != text]
    if {f.name for f in rest} & {"ids", "decoded"}:
        raise ValueError("columns named ids or decoded would clash with the result")
    schema = T.StructType([*rest, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    ordered = df.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text}`"))
    at = len(rest)
    return ordered.mapInArrow(lambda batches: _rows(batches, at, vocab, pattern, leaf_chars), schema)


def token_digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` from the columns ``ids`` and ``decoded``."""
    return (encoded
            .withColumn("n_tokens", F.size("ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256))
            .withColumn("decoded_sha256", F.sha2("decoded", 256))
            .drop("ids", "decoded"))
