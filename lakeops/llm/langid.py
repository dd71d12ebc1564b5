"""Language identification by prediction by partial matching (PPM) over bytes.

Fitting counts, for every language and every order 0 .. ``order``, which byte follows which context, in a
bounded choice of labelled rows. The counts are then frozen. In a context seen n times with q different
followers, a follower seen c times has probability c / (n + q), and q / (n + q) is the probability of
escaping to the next shorter context; an unseen context escapes for free; below order 0 all 256 bytes are
equal. A text's code length under a language is the sum over its bytes; the shortest wins (ties: the
smaller name), and the score is the winner's share of 2^-length over all languages.

Scoring keeps, per order, the contexts-with-follower as one sorted array of packed bytes with the fully
resolved code length under every language, so a byte costs one binary search at the highest order, and
more only for the bytes that escape everywhere.

Fitting rows: those with a label, at most ``max_chars`` characters each, chosen by a hash of the whole row so
that about ``fitting_chars`` characters per language are expected; each chosen row counts whole. The model
is therefore bounded by ``languages x fitting_chars x (order + 1)`` whatever the input, and may be
broadcast. Every text is scored.

Defined cases: a null text, a text without a letter, and any text when nothing was learned get ``und``
with score 0; labels that are null teach nothing; repeated rows are scored one by one; very long texts
are scored in pieces with their context carried over; other columns pass through (names that clash with
the result raise ``ValueError``); empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm import blocks as bl

UNDETERMINED = "und"
PIECE = 1 << 18
MAX_ORDER = 6


def _grams(data: np.ndarray, length: int) -> np.ndarray:
    """Packed big-endian ``length``-grams of ``data``, one per end position >= length - 1."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = (out << np.uint64(8)) | data[i:i + n].astype(np.uint64)
    return out


def _count_batches(batches, order: int):
    """(lang, length, gram, n): local counts of every gram of 1 .. order + 1 bytes."""
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(lang, []).append(text.encode("utf-8", "surrogatepass"))
        for lang, parts in texts.items():
            for length in range(1, order + 2):
                grams = np.concatenate([_grams(np.frombuffer(p, np.uint8), length) for p in parts])
                keys, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([length] * len(keys), pa.int32()),
                     pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "length", "gram", "n"])


class PpmModel:
    """Frozen statistics of all languages; ``bits(data)`` gives the code length of a text under each."""

    def __init__(self, langs: list[str], order: int, counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        """``counts[length]``: sorted distinct grams and an array (gram, language) of their counts."""
        self.langs, self.order = langs, order
        width = len(langs)
        self.keys: list[np.ndarray] = []
        self.cost: list[np.ndarray] = []       # resolved bits of the last byte given the bytes before
        self.context: list[np.ndarray] = []    # contexts of each order
        self.escape: list[np.ndarray] = []     # bits of escaping from them
        for k in range(order + 1):
            keys, n = counts[k + 1]
            context = keys >> np.uint64(8)
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.empty(0, np.int64)
            total = np.add.reduceat(n, first, axis=0) if len(keys) else np.zeros((0, width))
            kinds = np.add.reduceat((n > 0).astype(np.float64), first, axis=0) if len(keys) else np.zeros((0, width))
            seen = total > 0
            escape = np.where(seen, -np.log2(np.where(seen, kinds, 1) / np.where(seen, total + kinds, 1)), 0.0)
            of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
            self.context.append(context[first])
            self.escape.append(escape)
            shorter = self._cost(keys & np.uint64((1 << (8 * k)) - 1), k - 1)
            own = -np.log2(np.where(n > 0, n, 1) / np.maximum(total + kinds, 1)[of])
            self.keys.append(keys)
            self.cost.append(np.where(n > 0, own, escape[of] + shorter))

    def _cost(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Bits of the last byte of packed (k + 1)-grams at order ``k``, for every language."""
        if k < 0:
            return np.full((len(grams), len(self.langs)), 8.0)
        at, hit = _find(self.keys[k], grams)
        out = np.empty((len(grams), len(self.langs)))
        out[hit] = self.cost[k][at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            lost = grams[miss]
            cost = self._cost(lost & np.uint64((1 << (8 * k)) - 1), k - 1)
            c, known = _find(self.context[k], lost >> np.uint64(8))
            cost[known] += self.escape[k][c[known]]
            out[miss] = cost
        return out

    def bits(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code lengths (text, language) of the texts concatenated in ``data`` that end at ``ends``."""
        out = np.zeros((len(ends), len(self.langs)))
        starts = np.r_[0, ends[:-1]]
        full = self.order + 1
        grams = _grams(data, full)
        # A gram that would reach back into the text before is scored at the order its own text allows.
        inside = np.arange(len(data)) - np.repeat(starts, ends - starts)
        deep = np.flatnonzero(inside >= self.order)
        owner = np.repeat(np.arange(len(ends)), ends - starts)
        for lo in range(0, len(deep), PIECE):
            part = deep[lo:lo + PIECE]
            cost = self._cost(grams[part - self.order], self.order)
            who = owner[part]
            for lang in range(len(self.langs)):
                out[:, lang] += np.bincount(who, cost[:, lang], len(ends))
        for k in range(self.order):
            part = np.flatnonzero(inside == k)
            if len(part):
                cost = self._cost(_grams(data, k + 1)[part - k], k)
                np.add.at(out, owner[part], cost)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in rows]
        begin = 0
        while begin < len(rows):  # groups of texts of about PIECE bytes
            stop, size = begin, 0
            while stop < len(rows) and (stop == begin or size + len(raw[stop]) <= PIECE):
                size += len(raw[stop])
                stop += 1
            bits = self.bits(np.frombuffer(b"".join(raw[begin:stop]), np.uint8), np.cumsum([len(x) for x in raw[begin:stop]]))
            best = bits.argmin(axis=1)
            share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            for j in range(begin, stop):
                names[rows[j]], scores[rows[j]] = self.langs[best[j - begin]], float(share[j - begin])
            begin = stop
        return names, scores


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", order: int = 4,
        fitting_chars: int = 1_500_000, max_chars: int = 100_000) -> PpmModel:
    """Learn from the rows of ``labelled`` with a label and a text (see the module for the choice)."""
    if not 0 <= order <= MAX_ORDER:
        raise ValueError(f"order must be 0 to {MAX_ORDER}")
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                           F.hash(*[F.col(f"`{c}`") for c in labelled.columns]).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= max_chars))
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"))
    share = (F.pmod(F.col("h").cast("long"), F.lit(1 << 20)) / (1 << 20)) * F.col("chars") < fitting_chars
    chosen = rows.join(F.broadcast(sizes), "lang").where(share).select("lang", "text")
    local = chosen.mapInArrow(lambda batches: _count_batches(batches, order), "lang string, length int, gram long, n long")
    total = local.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(total.column("lang").to_pylist()))
    code = np.searchsorted(np.array(names, dtype=object), np.array(total.column("lang").to_pylist(), dtype=object)) if names else np.empty(0, int)
    length = total.column("length").to_numpy()
    gram = total.column("gram").to_numpy().view(np.uint64)
    n = total.column("n").to_numpy()
    counts = {}
    for size in range(1, order + 2):
        of = length == size
        keys, at = np.unique(gram[of], return_inverse=True)
        table = np.zeros((len(keys), len(names)))
        table[at, code[of]] = n[of]
        counts[size] = (keys, table)
    return PpmModel(names, order, counts)


def predict(df: DataFrame, model: PpmModel, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``. Only ``text`` is looked at."""
    if {"lang_pred", "score"} & set(df.columns):
        raise ValueError("columns named lang_pred or score would clash with the result")
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                names, scores = shared.value.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 [*part.schema.names, "lang_pred", "score"])
        bl.release()

    return df.mapInArrow(rows, schema)


def fold(doc_id: str = "doc_id", folds: int = 4):
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(-1))


def learn_from_folds(documents: DataFrame, held_out: int = 2, folds: int = 4, **how) -> PpmModel:
    """Fit on documents whose fold is not ``held_out``; rows with a null id teach nothing."""
    keep = (fold(folds=folds) != held_out) & (fold(folds=folds) >= 0)
    return fit(documents.where(keep).select("doc_id", "text", "lang"), **how)
