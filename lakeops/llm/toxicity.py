"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

Texts are folded to 64 symbols (case folded; other letters by a rule) and cut into pieces: words, with separators
inside a word or between single letters that stand apart left out, so that spelt-out insults are one piece. The kernel
of two pieces, k(x, z) = sum over triples u of symbols of phi_u(x) * phi_u(z), counts u wherever its symbols follow
each other within ``REACH`` places, each occurrence weighted by ``DECAY`` to the power of the places it spans, divided
by the norm of a piece of that length; inserted characters make an occurrence weaker and do not end it.

Fitting takes labelled sentences: every sentence of a labelled document carries its label, a toxic document is known to
hold at least one insult, a clean one holds none. Rounds of the multiple-instance machine choose the pieces of toxic
sentences that count as insults (first by their frequency in toxic and clean documents, then by their margin) and the
clean pieces nearest to them; landmarks are drawn from both, pieces become Nyström features (kernel to the landmarks,
times the inverse root of the landmarks' own kernel), and a squared-hinge machine is solved by Newton steps. Since the
kernel is a sum over u, the machine over landmarks is exactly one weight per u, and scoring adds these weights over the
triples of the whole text. A document's score is a logistic function of its three largest margins, of how many
exceed zero, alone and against its length, fitted on labelled rows that the machine has not seen.

Bounds: fitting uses at most about ``toxic_rows`` and ``clean_rows`` labelled rows, chosen by a hash of the id, of at
most ``max_chars`` characters each; ``landmarks`` bounds the machine. Every text is scored whole, in one pass without a
shuffle; memory follows ``GROUP_CHARS`` or the longest text.

Defined cases: a null or empty text is scored like a text without words; documents with several labels are toxic if one
of them is 1; null labels and ids teach nothing; without rows of both labels nothing is learned and every score is 0;
repeated rows are scored alike; other columns pass through, names that clash with the result raise ``ValueError``;
empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm import blocks as bl
from lakeops.llm import textbytes as tb

REACH, DECAY = 4, np.float32(0.7)
EDGE, OTHER_LETTERS, DIGIT, REST, JOINT, HARD = 0, 27, 57, 58, 59, 63
GROUP_CHARS = 1 << 18
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
FLOOR, CEILING = -1.0, 1.0
#: Evidence (nats) with which a piece is an insult in every round, and with which a document's best one is in the first.
CERTAIN, LIKELY = 12.0, 5.0
TOP = 3
#: Texts of fewer pieces count as that long where margins over zero are set against the length.
SHORT = 50
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Symbol of every code point of the basic plane: letters a-z by number, other letters by a rule, digits, marks;
    white space and punctuation separate."""
    if not _FOLD:
        table = np.full(1 << 16, JOINT, np.uint8)
        for code in range(1 << 16):
            c = chr(code).lower()[0]
            if "a" <= c <= "z":
                table[code] = 1 + ord(c) - ord("a")
            elif c.isalpha():
                table[code] = OTHER_LETTERS + ord(c) % (DIGIT - OTHER_LETTERS)
            elif c.isdigit():
                table[code] = DIGIT
            elif c.isspace():
                table[code] = EDGE
            elif code > 127 and not c.isprintable():
                table[code] = REST
        table[ord("\n")] = HARD
        _FOLD.append(table)
    return _FOLD[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, separators as ``EDGE`` (before, between and after texts too), and where each text starts."""
    whole = "\n".join(["", *texts, ""])
    code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = np.where(code < 1 << 16, _fold_table()[np.minimum(code, (1 << 16) - 1)], np.uint8(REST))
    begins = np.r_[0, np.cumsum([len(t) + 1 for t in texts])].astype(np.int64)
    letter = (raw > EDGE) & (raw < JOINT)
    start, stop = tb.runs(letter)
    if len(start) > 1:
        size = stop - start
        lone = start[1:] - stop[:-1] == 1
        short, between = np.minimum(size[1:], size[:-1]), raw[stop[:-1]]
        out = lone & (((between == JOINT) & (short <= 2)) | ((between == EDGE) & (np.maximum(size[1:], size[:-1]) == 1)))
        keep = np.ones(len(raw), bool)
        keep[stop[:-1][out]] = False
        begins = np.r_[0, np.cumsum(keep)][begins]
        raw, letter = raw[keep], letter[keep]
    return np.where(letter, raw, np.uint8(EDGE)), begins


def piece_bounds(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the edge before each piece and the edge after it stand."""
    start, stop = tb.runs(s > EDGE)
    return start - 1, stop


def norms(longest: int) -> np.ndarray:
    """Norm of a piece by the number of its symbols, edges included: the root of its occurrences' squared weights."""
    m = np.arange(longest + 1)
    total = sum((b - 1) * np.maximum(m - b, 0) * float(DECAY) ** (2 * (b + 1)) for b in range(2, REACH + 1))
    return np.sqrt(np.maximum(total, 1e-9)).astype(np.float32)


def occurrences(s: np.ndarray):
    """(first place, triple, weight) arrays for every pair of gaps; triples never reach over an edge."""
    n = len(s)
    wide = np.zeros(n + REACH, np.int32)
    wide[:n] = s
    edge = wide == EDGE
    open_ = np.ones(n, bool)
    first = wide[:n] << 12
    for b in range(2, REACH + 1):
        open_ &= ~edge[b - 1:b - 1 + n]
        last = first | wide[b:b + n]
        for a in range(1, b):
            yield open_, last | wide[a:a + n] << 6, DECAY ** (b + 1)


def margins(s: np.ndarray, weights: np.ndarray, bias: float, normal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margin of every piece, and where it starts."""
    start, stop = piece_bounds(s)
    if not len(start):
        return np.empty(0, np.float32), start
    total, part, b = np.zeros(len(s), np.float32), None, 0.0
    mask = None
    for open_, triple, weight in occurrences(s):
        if part is not None and weight != b:
            total += part * mask * b
            part = None
        if part is None:
            part, b, mask = weights[triple], weight, open_.astype(np.float32)
        else:
            part += weights[triple]
    total += part * mask * b
    return np.add.reduceat(total, start) / _norm_of(stop - start + 1, normal) + np.float32(bias), start


def _norm_of(size: np.ndarray, normal: np.ndarray) -> np.ndarray:
    if len(size) and size.max() >= len(normal):
        normal = norms(int(size.max()))
    return normal[size]


def document_features(margin: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(text, feature) from the margins of all pieces; ``first[i]`` is the first piece of text i."""
    count = np.diff(first)
    out = np.zeros((len(count), TOP + 2))
    out[:, :TOP] = FLOOR
    some = np.flatnonzero(count)
    if len(some):
        left = np.clip(margin, FLOOR, CEILING).astype(np.float64)
        at = first[:-1][some]
        hits = np.add.reduceat((left > 0).astype(np.float64), at)
        out[some, TOP] = np.log1p(hits)
        out[some, TOP + 1] = np.log1p(100 * hits / np.maximum(count[some], SHORT))
        owner = np.repeat(np.arange(len(some)), count[some])
        for k in range(TOP):
            best = np.maximum.reduceat(left, at)
            out[some, k] = np.maximum(best, FLOOR)
            hit = np.flatnonzero(left == best[owner])
            left[hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]] = -np.inf
    return out


class Machine:
    """One weight per triple (the landmarks' weights added up), and the document's logistic function."""

    def __init__(self, weights: np.ndarray, bias: float, scale: np.ndarray):
        self.weights, self.bias, self.scale, self.normal = weights, bias, scale, norms(64)

    def features(self, texts: list[str]) -> np.ndarray:
        s, begins = symbols(texts)
        margin, start = margins(s, self.weights, self.bias, self.normal)
        return document_features(margin, np.searchsorted(start, begins))

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.features(texts) @ self.scale[:-1] + self.scale[-1], -30, 30)))


def _as_buffer(pieces: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"\0" + b"\0".join([*pieces, b""]), np.uint8)


def kernel_parts(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, triple, normalised weight) of all pieces, sorted by piece and triple, equal ones added."""
    s = _as_buffer(pieces)
    start, stop = piece_bounds(s)
    owner = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(s)]))
    keys, values = [], []
    for open_, triple, weight in occurrences(s):
        at = np.flatnonzero(open_[:len(owner)])
        keys.append(owner[at].astype(np.int64) << 18 | triple[at])
        values.append(np.full(len(at), weight))
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(where, np.concatenate(values))
    piece = key >> 18
    return piece, key & ((1 << 18) - 1), value / norms(int((stop - start).max()) + 1)[(stop - start + 1)[piece]]


def _to_landmarks(pieces: list[bytes], used: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Kernel of every piece with every landmark; ``z`` (triple, landmark) has a row for each triple in ``used``."""
    out = np.zeros((len(pieces), z.shape[1]))
    for lo in range(0, len(pieces), 2000):
        piece, triple, value = kernel_parts(pieces[lo:lo + 2000])
        at = np.minimum(np.searchsorted(used, triple), len(used) - 1)
        hit = used[at] == triple
        piece, at, value = piece[hit], at[hit], value[hit]
        for a in range(0, len(piece), 20_000):
            rows, first = np.unique(piece[a:a + 20_000], return_index=True)
            out[lo + rows] += np.add.reduceat(z[at[a:a + 20_000]] * value[a:a + 20_000, None], first, axis=0)
    return out


def _solve(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float) -> np.ndarray:
    """Squared-hinge machine by Newton steps on the rows inside the margin."""
    x = np.c_[x, np.ones(len(x))]
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w, active = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(30):
        a = x[active] * cost[active, None]
        w = np.linalg.solve(a.T @ x[active] + np.diag(keep), a.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _rising_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic function of the first columns of ``x``, as few as fit nearly as well as all, in which none lowers the
    chance (columns that would are left out, the worst first)."""
    fits = []
    for count in range(1, x.shape[1] + 1):
        used = list(range(count))
        while (w := _logistic(x[:, used], y))[:-1].min() < 0:
            del used[int(w[:-1].argmin())]
        out = np.zeros(x.shape[1] + 1)
        out[[*used, -1]] = w
        chance = np.clip(1 / (1 + np.exp(-np.clip(x @ out[:-1] + out[-1], -30, 30))), 1e-9, 1 - 1e-9)
        fits.append((out, -np.log(np.where(y > 0, chance, 1 - chance)).mean()))
    best = min(loss for _, loss in fits)
    return next(w for w, loss in fits if loss <= 1.1 * best + 0.01)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    keep = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _spread(pieces: list[bytes], count: int) -> list[bytes]:
    """At most ``count`` pieces, evenly through the list."""
    return [pieces[i] for i in np.unique(np.linspace(0, len(pieces) - 1, min(count, len(pieces))).astype(int))] if pieces else []


def train(texts: list[str], toxic: list[bool], landmarks: int = 384, rounds: int = 3, clean: int = 8_000,
          ridge: float = 1.0) -> Machine | None:
    """The machine from labelled documents; None unless both labels are there."""
    y = np.array(toxic, bool)
    teach = np.arange(len(y)) % 10 < 7 if len(y) >= 100 else np.ones(len(y), bool)
    if not (y & teach).any() or not (~y & teach).any():
        return None
    bags: list[Counter] = []
    seen_toxic, seen_clean = Counter(), Counter()
    for text, bad in zip([texts[i] for i in np.flatnonzero(teach)], y[teach]):
        bag: Counter = Counter()
        for sentence in SENTENCE.split(text):
            s, _ = symbols([sentence])
            raw = s.tobytes()
            bag.update(p for p in raw.split(b"\0") if p)
        (seen_toxic if bad else seen_clean).update(bag.keys())
        if bad and bag:
            bags.append(bag)
    n_toxic, n_clean = int((y & teach).sum()), int((~y & teach).sum())
    if not bags or not seen_clean:
        return None

    share = n_toxic / (n_toxic + n_clean)

    def evidence(p: bytes) -> float:
        """Log of how much likelier the piece's documents are with its own share of toxic ones than with the usual."""
        a, b = seen_toxic[p], seen_clean[p]
        own = a / (a + b)
        return a * np.log(own / share) + (b * np.log((1 - own) / (1 - share)) if b else 0.0) if own > share else 0.0

    proof = {p: evidence(p) for p in seen_toxic}
    value = dict(proof)
    common = sorted(seen_clean, key=lambda p: (-seen_clean[p], p))
    rest = _spread(sorted(seen_clean), clean // 2)
    near: list[bytes] = []
    weights, bias = np.zeros(1 << 18, np.float32), 0.0
    for step in range(rounds):
        chosen: Counter = Counter()
        for bag in bags:
            best, proven = (max(bag, key=lambda p: (v[p], p)) for v in (value, proof))
            chosen.update(p for p in bag if proof[p] >= CERTAIN or (p == proven and proof[p] > LIKELY) or
                          (step and (value[p] > 0.5 or (p == best and value[p] > 0))))
        insults = sorted(p for p in chosen if seen_toxic[p] > seen_clean[p])
        if not insults:
            return None
        other = sorted((set(common[:clean // 4]) | set(rest) | set(near)) - set(insults))
        marks = _spread(sorted(insults, key=lambda p: (-chosen[p], p))[:landmarks], landmarks // 2)
        marks += _spread(near, landmarks // 4) + _spread(other, landmarks // 4)
        marks = sorted(set(marks))
        piece, triple, part = kernel_parts(marks)
        used, at = np.unique(triple, return_inverse=True)
        z = np.zeros((len(used), len(marks)))
        z[at, piece] = part
        own, axis = np.linalg.eigh(z.T @ z)
        root = axis / np.sqrt(np.maximum(own, 1e-4 * own.max()))
        pieces = insults + other
        x = _to_landmarks(pieces, used, z) @ root
        target = np.r_[np.ones(len(insults)), -np.ones(len(other))]
        cost = np.r_[[float(chosen[p]) for p in insults], [1.0 + np.log1p(seen_clean[p]) for p in other]]
        cost[:len(insults)] *= cost[len(insults):].sum() / cost[:len(insults)].sum() / 2
        w = _solve(x, target, cost, ridge * cost.sum() / 1000)
        weights, bias = np.zeros(1 << 18, np.float32), float(w[-1])
        weights[used] = z @ (root @ w[:-1])
        found = margins(_as_buffer(everything := sorted(seen_toxic)), weights, bias, norms(64))[0]
        value = dict(zip(everything, found.tolist()))
        score = margins(_as_buffer(everything := sorted(seen_clean)), weights, bias, norms(64))[0]
        near = [everything[i] for i in np.argsort(-score, kind="stable")[:clean // 4]]
    machine = Machine(weights, bias, np.zeros(TOP + 3))
    calibrate = ~teach if (y & ~teach).sum() >= 10 and (~y & ~teach).sum() >= 10 else np.ones(len(y), bool)
    held = [texts[i] for i in np.flatnonzero(calibrate)]
    features = np.concatenate([machine.features(held[lo:lo + 64]) for lo in range(0, len(held), 64)])
    machine.scale = _rising_logistic(features, y[calibrate].astype(float))
    return machine


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        toxic_rows: int = 1000, clean_rows: int = 4000, max_chars: int = 20_000, **how) -> Machine | None:
    """Learn from the documents that ``labels`` (doc_id, label 0 or 1) names; see the module for the bounded choice."""
    marked = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
              .agg((F.max(label) == 1).alias("_toxic")))
    count = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    lot = F.pmod(F.xxhash64("_id", F.lit(12)), F.lit(1 << 30)) / (1 << 30)
    wanted = F.when(F.col("_toxic"), F.lit(toxic_rows / max(1, count.get(True, 0)))).otherwise(F.lit(clean_rows / max(1, count.get(False, 0))))
    rows = (documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(F.length("_text").between(1, max_chars))
            .join(F.broadcast(marked.where(lot < wanted)), "_id").collect())
    rows.sort(key=lambda r: (zlib.crc32(str(r["_id"]).encode()), r["_text"]))
    return train([r["_text"] for r in rows], [r["_toxic"] for r in rows], **how)


def score(df: DataFrame, machine: Machine | None, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1). Only ``text`` is looked at."""
    if "score" in df.columns:
        raise ValueError("a column named score would clash with the result")
    shared = df.sparkSession.sparkContext.broadcast(machine)
    at = df.columns.index(text)

    def rows(batches):
        for batch in batches:
            for lo, hi, texts in tb.text_groups(batch, at, GROUP_CHARS):
                found = shared.value.scores([t or "" for t in texts]) if shared.value else np.zeros(hi - lo)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], [*part.schema.names, "score"])
        bl.release()

    return df.mapInArrow(rows, T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType())]))
