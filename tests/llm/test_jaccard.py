import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import jaccard
from lakeops.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, share):
    sets = []
    for i, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[root(k)] = min(i, first.get(root(k), i))
    return sorted(((i, len(sets[k]), first.get(root(k)) if i is not None else None) for k, (i, _) in enumerate(rows)), key=str)


def run(df, width, share, **how):
    return sorted((tuple(r) for r in jaccard.near_classes(df, width, share, **how).collect()), key=str)


def near_copies(seed, groups=5, size=45):
    """Groups of near copies of one text each, so loose that a group links only through chains."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(60)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 50)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("leaf,pivots,limit", [(2, 2, 8 << 20), (6, 3, 0), (32, 8, 8 << 20)])
def test_levels_equal_brute_force(spark, monkeypatch, leaf, pivots, limit):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = near_copies(leaf)
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), 2, 85, broadcast_bytes=limit) == brute(rows, 2, 85)


def test_two_balls_that_touch(spark, monkeypatch):
    """Members of different cells link although their pivots do not: a chain of small steps."""
    monkeypatch.setattr(jaccard, "LEAF", 2)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    rows = [(i, " ".join([f"c{j}" for j in range(60)] + [f"w{j}" for j in range(i, i + 40)])) for i in range(0, 36, 2)]
    rows += [(100 + i, " ".join([f"c{j}" for j in range(60)] + [f"v{j}" for j in range(3 * i, 3 * i + 40)])) for i in range(10)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85) == brute(rows, 1, 85)


def test_defined_cases(hostile, no_docs):
    rows = [(r.doc_id, r.text) for r in hostile.select("doc_id", "text").collect()]
    assert run(hostile, 4, 85) == brute(rows, 4, 85)
    assert run(no_docs, 4, 85) == []


def test_coordinates_exclude_pairs_that_do_not_link():
    """Near copies of one text: every pair that links is kept, and hardly any other is measured."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 4000)}" for _ in range(150)]
    texts = []
    for i in range(120):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10_000)}"
        texts.append(" ".join(words))
    sets = jaccard.shingle_sets(texts, 4)
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if not np.array_equal(sets[a], sets[b])]
    side = lambda k: [pa.array([q[k] for q in pairs]), pa.array([len(sets[q[k]]) for q in pairs]),
                      pa.array([jaccard._coordinates(sets[q[k]]).tobytes() for q in pairs])]
    rows = pa.RecordBatch.from_arrays([*side(0), *side(1)], ["x", "nx", "sx", "p", "np", "sp"])
    kept = {(r["x"], r["p"]) for b in jaccard._may_link([rows], 85) for r in b.to_pylist()}
    common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in pairs}
    linked = {q for q in pairs if 100 * common[q] >= 85 * (len(sets[q[0]]) + len(sets[q[1]]) - common[q])}
    assert linked and linked <= kept
    assert len(kept - linked) <= 0.1 * (len(pairs) - len(linked))


def test_coordinates_of_unequal_sets_are_a_lower_bound():
    rng = np.random.default_rng(5)
    for n, m in ((40, 3000), (700, 700), (1, 200)):
        x, y = (np.unique(rng.integers(0, 5000, k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in (n, m))
        a, b = (jaccard._coordinates(s)[None] for s in (x, y))
        w = min(a.shape[1], b.shape[1])
        apart = int(np.bitwise_count(jaccard._folded(a, w) ^ jaccard._folded(b, w)).sum())
        assert 0 < apart <= len(np.setxor1d(x, y))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201), (300, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(1, 41), 100]} | {201: 200, 202: 200} | {k: v for k, v in got.items() if k == v}
