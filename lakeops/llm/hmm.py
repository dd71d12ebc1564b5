"""Hidden Markov language model and a smoothed unigram base, over words and one end token per text.

Counts. Documents are packed in blocks; a block sends its distinct words with their training counts to hash
buckets, a bucket adds them up and answers each block with the corpus counts of its words. So every count
covers the whole corpus, no vocabulary is gathered anywhere, and a frequent word is one entry per block.

Model. Every word of the training rows has emission chances of its own in every state, at any corpus size. A
word's chance in a state is its share of the corpus (count + 0.1, as in the base) times the state's part of its
expected counts, with ``PRIOR`` tokens spread over the states by their size, so a rare word leans on its states
only as far as it was seen. Unknown words are one type, as in the base; a state's chance of them is its share of
words seen once.

Training. Baum-Welch: each block runs the forward and backward recursions (scaled at every step) with the
emissions of its words and sends their expected counts (rounded to 1 / ``STEPS``) to the words' buckets; a bucket adds them up over the
corpus and answers each block, as with the counts. Starts, moves and sums per state travel with them; the driver
only gets these (a few numbers a state). For training a text is cut into stretches of ``STRETCH`` tokens, the
later ones starting from equal state chances. Scoring runs the scaled forward recursion over whole texts: the
exact likelihood.

Defined cases: null and empty texts are one end token; rows with a null id are never learned from and are not
held out; without training rows the counts are zero, so every word is unknown; repeated rows count and
are scored one by one; extra columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import blocks as bl
from lakeops.llm import textbytes as tb

STRETCH = 512
END = np.uint64(0x5BD1E9955BD1E995)
PIECE_BYTES = 1 << 20
STEPS = 4096  # expected counts are exchanged in such parts of a token
PRIOR = 1.0  # tokens of every word that are spread over the states


def _tokens(texts: list[str | None]):
    """Word hashes of all texts with an end token after each, and tokens per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data, begins = tb.join_texts(raw)
    data = tb.LOWER[data]
    starts, ends = tb.runs(tb.NOT_SPACE[data])
    counts = tb.owner_counts(begins, starts)
    words = tb.span_hash(tb.prefix_hash(data), starts, ends)
    return np.insert(words, np.cumsum(counts), END), counts + 1


def _block_tokens(payload: bytes):
    batch = bl.from_bytes(payload)
    parts = [_tokens(texts) for _, _, texts in tb.text_groups(batch, batch.schema.get_field_index("text"), PIECE_BYTES)]
    return batch, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _learned(batch) -> np.ndarray:
    return np.array(batch.column("learned").to_pylist(), bool)


_SENT = "bucket long, block long, payload binary"


def _scatter(batches, buckets: int):
    for rows in batches:
        for block, payload in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            batch, tokens, sizes = _block_tokens(payload)
            taught = np.repeat(_learned(batch), sizes)
            words, at = np.unique(tokens, return_inverse=True)
            n = np.bincount(at, taught, len(words)).astype(np.int64)
            yield from _by_bucket(block, words, buckets, lambda lo, hi, words=words, n=n: bl.columns_to_bytes(
                words=bl.pack_sorted(words[lo:hi]), n=n[lo:hi].astype(np.int32)))


def _by_bucket(block: int, words: np.ndarray, buckets: int, payload):
    """(bucket, block, payload) for every bucket of the sorted words."""
    of = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    for lo, hi in zip(cuts.tolist(), np.r_[cuts[1:], len(of)].tolist()):
        yield pa.RecordBatch.from_arrays([pa.array([int(of[lo])], pa.int64()), pa.array([block], pa.int64()),
                                          pa.array([payload(lo, hi)], pa.binary())], ["bucket", "block", "payload"])


_ADDED = "bucket long, block long, payload binary, sums array<double>"


def _told(table: pa.Table, bucket: int, payloads: list[bytes], sums: np.ndarray) -> pa.Table:
    """Answers to every block that sent, and with the first row the bucket's sums."""
    first = [sums.tolist()] + [None] * (len(payloads) - 1)
    return pa.Table.from_arrays(
        [pa.array([bucket] * len(payloads), pa.int64()), table.column("block"), pa.array(payloads, pa.binary()), pa.array(first, pa.list_(pa.float64()))],
        names=["bucket", "block", "payload", "sums"])


def _add(bucket: int, table: pa.Table, states: int) -> pa.Table:
    """Corpus counts of one bucket's words. Sums: tokens, distinct words, and the first emissions of every state."""
    sent = [bl.columns_from_bytes(p) for p in table.column("payload").to_pylist()]
    words = [bl.unpack_sorted(x["words"]) for x in sent]
    every, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, np.concatenate([x["n"] for x in sent])).astype(np.int64)
    out, begin = [], 0
    for w in words:
        out.append(bl.columns_to_bytes(n=total[at[begin:begin + len(w)]]))
        begin += len(w)
    known = total > 0
    whole = ((total[known] + 0.1)[:, None] * _uneven(every[known], states)).sum(axis=0)
    return _told(table, bucket, out, np.r_[total.sum(), known.sum(), whole])


def _uneven(words: np.ndarray, states: int) -> np.ndarray:
    """Log-normal factors that follow from word and state: the first round can tell kinds of text apart."""
    out = np.empty((len(words), states))
    even = lambda k: ((tb.mix(words ^ tb.mix(np.array([k + 1], np.uint64))) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    for k in range(states):
        out[:, k] = np.exp(np.sqrt(-2 * np.log(even(2 * k))) * np.cos(2 * np.pi * even(2 * k + 1)))
    return out


def _sums(answers: DataFrame) -> np.ndarray:
    rows = answers.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    return np.array([r["sum"] for r in sorted(rows)], np.float64)


def _answered(answers: list) -> list[dict]:
    """A block's answers, in the order of its words: buckets hold ranges of hashes."""
    return [bl.columns_from_bytes(a["payload"]) for a in sorted(answers, key=lambda a: a["bucket"])]


def _with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    return blocks.join(answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("answers")), "block")


_ENCODED = "block long, payload binary, words binary"


def _encode(batches, total: int, kinds: int):
    """Of every block: its words with their corpus counts; per document base score and counts, and its tokens as
    places in the block's words."""
    for block, payload, answers in bl.rows_of(batches):
        batch, tokens, sizes = _block_tokens(payload)
        words, at = np.unique(tokens, return_inverse=True)
        n = np.concatenate([x["n"] for x in _answered(answers)])
        base = np.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))
        first = np.r_[0, np.cumsum(sizes)[:-1]]
        add = lambda x: np.add.reduceat(x[at], first)
        symbols = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(at.astype(np.int32)))
        out = pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("learned"), batch.column("held_out"), pa.array(sizes.astype(np.int64)),
             pa.array(add((n > 0).astype(np.int64))), pa.array(add(base)), symbols],
            ["doc_id", "learned", "held_out", "n_tokens", "n_known", "base_score", "symbols"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([bl.to_bytes(out)], pa.binary()),
             pa.array([bl.columns_to_bytes(words=bl.pack_sorted(words), n=n)], pa.binary())], ["block", "payload", "words"])


class Shared:
    """What all blocks share of a model: start and transition chances, and per state the sum that makes emissions
    chances, the state's share of all tokens, and its chance of unknown words."""

    def __init__(self, start: np.ndarray, move: np.ndarray, whole: np.ndarray, share: np.ndarray, unknown: np.ndarray):
        self.start, self.move, self.whole, self.share, self.unknown = start, move, np.maximum(whole, 1e-300), share, unknown

    def of_block(self, known: bytes, answers: list | None):
        """The model over a block's words, the words, and their corpus counts."""
        x = bl.columns_from_bytes(known)
        words, n = bl.unpack_sorted(x["words"]), x["n"]
        if answers is None:
            parts = (n + 0.1)[:, None] * _uneven(words, len(self.start))
        else:
            expected = np.concatenate([_join_planes(a["expected"]) for a in _answered(answers)]).reshape(len(words), -1)
            parts = ((n + 0.1) / (n + PRIOR))[:, None] * (expected + PRIOR * self.share)
        emit = parts / self.whole * (1 - self.unknown)
        emit[n == 0] = self.unknown
        return Hmm(self.start, self.move, emit), words, n


def _planes(x: np.ndarray) -> np.ndarray:
    """Expected counts in steps of 1 / ``STEPS``, byte planes apart: nearly all are whole or zero and compress away."""
    steps = np.rint(x.ravel() * STEPS).astype(np.uint64)
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).reshape(-1)


def _join_planes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64) / STEPS


class Hmm:
    """Start, transition and emission chances of a hidden Markov chain over symbols."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K), (K, K), (symbols, K)

    @classmethod
    def first(cls, mass: np.ndarray, states: int, seed: int = 11) -> Hmm:
        rng = np.random.default_rng(seed)
        # Uneven emissions and states that tend to last: the first round can tell kinds of text apart.
        emit = mass[:, None] * np.exp(rng.normal(0, 1.0, (len(mass), states)))
        move = rng.uniform(0.5, 1.5, (states, states)) + 20.0 * states * np.eye(states)
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def log10(self, symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Exact log10 likelihood of each sequence by the scaled forward recursion."""
        order = np.argsort(-sizes, kind="stable")
        first, sizes = first[order], sizes[order]
        out = np.zeros(len(order))
        active = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left")
        state = np.tile(self.start, (len(order), 1))
        for t, m in enumerate(active.tolist()):
            state = state[:m] if t == 0 else state[:m] @ self.move
            state *= self.emit[symbols[first[:m] + t]]
            scale = state.sum(axis=1)
            state /= scale[:, None]
            out[:m] += np.log10(scale)
        back = np.empty(len(order))
        back[order] = out
        return back

    def expect(self, symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, fresh: np.ndarray):
        """Expected starts, moves and emissions of the sequences; ``fresh``: starts of whole texts."""
        states = len(self.start)
        order = np.argsort(-sizes, kind="stable")
        first, sizes, fresh = first[order], sizes[order], fresh[order]
        active = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), side="left").tolist()
        place = np.r_[0, np.cumsum(active)]
        forward = np.empty((place[-1], states))
        seen = np.empty((place[-1], states))
        scale = np.empty(place[-1])
        token = np.empty(place[-1], np.int64)
        state = np.where(fresh[:, None], self.start, 1 / states)
        for t, m in enumerate(active):
            at = slice(place[t], place[t + 1])
            token[at] = symbols[first[:m] + t]
            seen[at] = self.emit[token[at]]
            state = state[:m] if t == 0 else state[:m] @ self.move
            state = state * seen[at]
            scale[at] = state.sum(axis=1)
            state /= scale[at][:, None]
            forward[at] = state
        moves = np.zeros((states, states))
        back = np.ones((len(order), states))
        gamma = np.empty_like(forward)
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            at = slice(place[t], place[t + 1])
            if t + 1 < len(active):
                later = active[t + 1]
                nxt = slice(place[t + 1], place[t + 2])
                ahead = seen[nxt] * back[:later] / scale[nxt][:, None]
                moves += forward[place[t]:place[t] + later].T @ ahead
                back[:later] = ahead @ self.move.T
            gamma[at] = forward[at] * back[:m]
        moves *= self.move
        emits = np.stack([np.bincount(token, gamma[:, k], len(self.emit)) for k in range(states)], axis=1)
        begin = gamma[:len(order)][fresh].sum(axis=0) if len(order) else np.zeros(states)
        return begin, moves, emits


def _sequences(payload: bytes):
    batch = bl.from_bytes(payload)
    column = batch.column("symbols")
    sizes = np.diff(column.offsets.to_numpy())
    return batch, column.values.to_numpy().astype(np.int64), column.offsets.to_numpy()[:-1].astype(np.int64), sizes.astype(np.int64)


def _expectations(batches, shared: Shared, buckets: int):
    states = len(shared.start)
    for block, payload, known, *answers in bl.rows_of(batches):
        model, words, n = shared.of_block(known, answers[0] if answers else None)
        batch, symbols, first, sizes = _sequences(payload)
        taught = _learned(batch)
        first, sizes = first[taught], sizes[taught]
        parts = -(-sizes // STRETCH)
        inner = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(first, parts) + inner * STRETCH
        size = np.minimum(np.repeat(sizes, parts) - inner * STRETCH, STRETCH)
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros((len(words), states))]
        for lo, hi in tb.groups(size.tolist(), 400_000):
            for to, found in zip(sums, model.expect(symbols, begin[lo:hi], size[lo:hi], inner[lo:hi] == 0)):
                to += found
        chain = np.r_[sums[0], sums[1].ravel()]  # travels with the first bucket's words
        yield from _by_bucket(block, words, buckets, lambda lo, hi, words=words, n=n, sums=sums, chain=chain: bl.columns_to_bytes(
            words=bl.pack_sorted(words[lo:hi]), n=n[lo:hi], expected=_planes(sums[2][lo:hi]), chain=chain if lo == 0 else chain[:0]))


def _add_expected(bucket: int, table: pa.Table, states: int) -> pa.Table:
    """Expected counts of one bucket's words over the corpus. Sums: starts, moves, and per state the expected counts,
    those of words seen once, and the two parts of the sum that makes emissions chances."""
    sent = [bl.columns_from_bytes(p) for p in table.column("payload").to_pylist()]
    words = [bl.unpack_sorted(x["words"]) for x in sent]
    every, first, at = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    n = np.concatenate([x["n"] for x in sent])[first]
    expected = np.concatenate([_join_planes(x["expected"]) for x in sent]).reshape(-1, states)
    total = np.stack([np.bincount(at, expected[:, k], len(every)) for k in range(states)], axis=1)
    out, begin = [], 0
    for w in words:
        out.append(bl.columns_to_bytes(expected=_planes(total[at[begin:begin + len(w)]])))
        begin += len(w)
    part = np.where(n > 0, (n + 0.1) / (n + PRIOR), 0.0)
    chain = sum((x["chain"] for x in sent if len(x["chain"])), np.zeros(states + states * states))
    return _told(table, bucket, out, np.r_[chain, total.sum(axis=0), total[n == 1].sum(axis=0), part @ total, part.sum()])


def train(encoded: DataFrame, counts: np.ndarray, states: int, rounds: int, buckets: int) -> tuple[Shared, DataFrame | None]:
    """The shared part of the model, and the expected counts told to every block (None without rounds)."""
    rare = 0.1 / (counts[0] + 0.1 * (counts[1] + 1))
    begin = Hmm.first(np.ones(1), states)
    model = Shared(begin.start, begin.move, counts[2:], np.full(states, 1 / states), np.full(states, min(rare, 0.5)))
    store, answers = bl.Store(encoded.sparkSession), None
    for _ in range(rounds):
        rows = encoded if answers is None else _with_answers(encoded, answers)
        answers = store.result(rows.mapInArrow(lambda b, m=model: _expectations(b, m, buckets), _SENT).groupBy("bucket").applyInArrow(
            lambda key, t: _add_expected(key[0].as_py(), t, states), _ADDED))
        sums = _sums(answers)
        starts, moves, size, once, parts, part = np.split(sums, np.cumsum([states, states * states, states, states, states]))
        share = size / size.sum() if size.sum() > 0 else np.full(states, 1 / states)
        starts, moves = starts + 0.1, moves.reshape(states, states) + 0.1
        model = Shared(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), parts + PRIOR * share * part,
                       share, np.clip(once / np.maximum(size, 1e-300), rare, 0.5))
    return model, answers


def _score(batches, shared: Shared):
    for _, payload, known, *answers in bl.rows_of(batches):
        model, _, _ = shared.of_block(known, answers[0] if answers else None)
        batch, symbols, first, sizes = _sequences(payload)
        keep = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(model.log10(symbols, first, sizes))], [*keep, "score"])


def score(documents: DataFrame, learned, held_out, doc_id: str = "doc_id", text: str = "text", states: int = 6,
          rounds: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10). ``learned`` and ``held_out``
    are conditions on ``documents``."""
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), learned.alias("learned"), held_out.alias("held_out"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    store = bl.Store(documents.sparkSession)
    blocks = bl.pack(docs, "text", store.keep)
    buckets = bl.bucket_count(blocks)
    added = store.keep(blocks.mapInArrow(lambda b: _scatter(b, buckets), _SENT)
                       .groupBy("bucket").applyInArrow(lambda key, t: _add(key[0].as_py(), t, states), _ADDED))
    counts = _sums(added)
    if not len(counts):
        counts = np.zeros(2 + states)
    total, kinds = int(counts[0]), int(counts[1])
    encoded = store.result(_with_answers(blocks, added).select("block", "payload", "answers")
                           .mapInArrow(lambda b: _encode(b, total, kinds), _ENCODED))
    model, answers = train(encoded, counts, states, rounds if not encoded.isEmpty() else 0, buckets)
    rows = encoded if answers is None else _with_answers(encoded, answers)
    out = rows.mapInArrow(lambda b: _score(b, model),
                          f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(total).cast("long"))
