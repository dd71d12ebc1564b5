import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakeops.llm import blocks, hmm, langid

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(model, symbols, fresh=True):
    """Forward and backward chances without scaling."""
    k = len(model.start)
    a, b = np.zeros((len(symbols), k)), np.ones((len(symbols), k))
    a[0] = (model.start if fresh else np.full(k, 1 / k)) * model.emit[symbols[0]]
    for t in range(1, len(symbols)):
        a[t] = a[t - 1] @ model.move * model.emit[symbols[t]]
    for t in range(len(symbols) - 2, -1, -1):
        b[t] = model.move @ (model.emit[symbols[t + 1]] * b[t + 1])
    return a, b


def test_recursions_equal_definition():
    rng = np.random.default_rng(3)
    model = hmm.Hmm.first(rng.random(9) + 0.1, 4)
    texts = [rng.integers(0, 9, n) for n in (6, 1, 11, 6, 2)]
    fresh = np.array([True, True, False, True, False])
    sizes = np.array([len(t) for t in texts])
    first, flat = np.cumsum(sizes) - sizes, np.concatenate(texts)
    start, moves, emits = np.zeros(4), np.zeros((4, 4)), np.zeros((9, 4))
    for x, new in zip(texts, fresh):
        a, b = slow(model, x, new)
        like = a[-1].sum()
        gamma = a * b / like
        start += gamma[0] if new else 0
        for t, s in enumerate(x):
            emits[s] += gamma[t]
            if t:
                moves += np.outer(a[t - 1], model.emit[s] * b[t]) * model.move / like
    got = model.expect(flat, first, sizes, fresh)
    assert all(np.allclose(g, w) for g, w in zip(got, (start, moves, emits)))
    assert np.allclose(model.log10(flat, first, sizes), [np.log10(slow(model, x)[0][-1].sum()) for x in texts])


def check_counts(docs, out):
    own = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    part = lambda i: -1 if i is None else zlib.crc32(str(i).encode()) % 10
    counts = Counter()
    for i, t in docs:
        if part(i) > 0:
            counts.update(own(t))
            counts[None] += 1
    n, kinds = sum(counts.values()), len(counts)
    want = []
    for i, t in docs:
        words = [*own(t), None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (kinds + 1))) for w in words)
        want.append((i, part(i) == 0, len(words), sum(w in counts for w in words), n, round(base, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in out)


def run(df, **how):
    part = langid.fold(folds=10)
    return hmm.score(df, part > 0, part == 0, **how).collect()


def test_base_and_defined_cases(spark, hostile, no_docs, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    check_counts([(r.doc_id, r.text) for r in hostile.collect()], run(hostile, states=2, rounds=2))
    assert run(no_docs) == []
    unlearned = hostile.where("doc_id is null")
    check_counts([(r.doc_id, r.text) for r in unlearned.collect()], run(unlearned, states=2))


def test_chances_sum_to_one(spark):
    """Over every word of a closed vocabulary, and the unknown type, the chances of a one-word text sum to one."""
    rows = [(i, "a b c d e f g"[: 1 + 2 * (i % 7)] + " z" * (i % 3)) for i in range(60)]
    probe = [(1000 + i, w) for i, w in enumerate(["a", "b", "c", "d", "e", "f", "g", "z", "unknown"])]
    taught = F.col("doc_id") < 1000
    df = spark.createDataFrame(rows + probe, "doc_id long, text string")
    out = {r.doc_id: r.score for r in hmm.score(df, taught, ~taught, states=1, rounds=2).collect()}
    empty = hmm.score(df.unionByName(spark.createDataFrame([(2000, "")], df.schema)), taught, ~taught, states=1, rounds=2)
    end = 10 ** next(r.score for r in empty.collect() if r.doc_id == 2000)
    assert abs(sum(10 ** out[i] for i, _ in probe) / end + end - 1) < 1e-6


def test_better_than_base_on_held_out(spark):
    out = run(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_have_states(spark):
    """Emissions of words seen a few times tell kinds of text apart: a held-out text of one kind is likelier than
    one that mixes kinds, though all words are rare."""
    rng = np.random.default_rng(5)
    kinds = [[f"{k}{i}" for i in range(400)] for k in "ab"]
    text = lambda words: " ".join(rng.choice(words, 40))
    rows = [(i, text(kinds[i % 2])) for i in range(120)]
    rows += [(1000 + i, text(kinds[i % 2])) for i in range(20)]
    rows += [(2000 + i, " ".join(w for pair in zip(rng.choice(kinds[0], 20), rng.choice(kinds[1], 20)) for w in pair)) for i in range(20)]
    taught = F.col("doc_id") < 1000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = hmm.score(df, taught, ~taught, states=2, rounds=10).collect()
    gain = lambda lo: np.mean([r.score - r.base_score for r in out if lo <= r.doc_id < lo + 1000])
    assert gain(1000) > gain(2000) + 2
