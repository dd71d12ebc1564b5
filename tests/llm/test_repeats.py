import random

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import blocks, repeats


def brute(rows, length):
    first = {}
    rank = lambda i: float("inf") if i is None else i
    for i, t in rows:
        for j in range(len(t) - length + 1):
            first[t[j:j + length]] = min(rank(i), first.get(t[j:j + length], float("inf")))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for j in range(len(t) - length + 1):
            if first[t[j:j + length]] < rank(i):
                gone[j:j + length] = b"\1" * length
        out.append((i, len(t), sum(gone), bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def run(df, length, **how):
    rows = repeats.remove_repeats(df, length, **how).select("doc_id", "n_bytes", "spans", "kept").collect()
    return sorted(((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), bytes(r.kept)) for r in rows), key=str)


@pytest.mark.parametrize("length,gram,block", [(5, 2, 8 << 20), (12, 5, 300), (3, 3, 100)])
def test_equals_brute_force(spark, monkeypatch, length, gram, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "PIECE", 97)
    monkeypatch.setattr(repeats, "SORT_AT_ONCE", 50)
    rng = random.Random(length)
    base = "".join(rng.choice("abcé \0") for _ in range(300))
    rows = []
    for i in range(60):
        a = rng.randrange(250)
        rows.append((rng.choice([i, i, 3, None]), "".join(rng.choice("xyz") for _ in range(rng.randint(0, 30))) + base[a:a + rng.randint(0, 60)]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(df, length, gram=gram) == brute([(i, t.encode()) for i, t in rows], length)


def test_hot_key_is_spread(spark, monkeypatch):
    """A line in other surroundings in every document: no bucket gathers the suffixes of its key."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    rng = random.Random(7)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    copied = [noise(8) for _ in range(5)]
    rows = [(i, noise(rng.randint(5, 40)) + (copied[i % 5] if i % 3 == 0 else noise(8)) + "-" * 30 + noise(rng.randint(5, 40))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = brute([(i, t.encode()) for i, t in rows], 24)
    assert sum(n for _, _, n, _ in want) > 0
    assert run(df, 24, gram=6) == run(df, 24, gram=6, at_once=100) == want


def test_hot_keys_are_told():
    keys = np.arange(3, dtype=np.uint64) << np.uint64(40)
    sent = [(b, next(repeats._send_keys(b, keys, np.full(3, b), np.array([1, 60, 1]), 1)).column("payload")[0].as_py()) for b in range(4)]
    table = pa.table({"block": [b for b, _ in sent], "payload": pa.array([p for _, p in sent], pa.binary())})
    told = repeats._shared_keys(table, 100)
    assert told.column("hot").to_pylist() == [True] * 4
    assert [x.tolist() for x in repeats._answered([told.column("payload")[0].as_py()])] == [keys.tolist(), [False, True, False]]


def test_defined_cases(hostile, no_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in hostile.select("doc_id", "text").collect()]
    assert run(hostile, 50) == brute(rows, 50)
    assert run(no_docs, 50) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(hostile.selectExpr("doc_id", "text", "1 as kept"))
    with pytest.raises(ValueError):
        repeats.remove_repeats(hostile.selectExpr("cast(doc_id as string) as doc_id", "text"))


def test_first_documents():
    rows = np.array([[1, 0], [1, 0], [1, 1], [0, 0], [1, 0]], np.uint8)
    assert repeats.first_documents(rows, np.array([5, 3, 9, 2, 4])).tolist() == [3, 3, 9, 2, 3]


def test_text_of_kept_bytes(spark):
    df = spark.createDataFrame([(bytearray("aé".encode()[:2]),), (None,), (bytearray("é�".encode()),)], "kept binary")
    assert [r[0] for r in df.select(repeats.kept_text(df.kept)).collect()] == ["a", None, "é�"]


@pytest.mark.parametrize("seed", range(6))
def test_longest_previous_factors(seed):
    """Against the definition: the longest prefix that an entry with a smaller id has too."""
    rng = np.random.default_rng(seed)
    width, n = 6, [0, 1, 2, 60, 200, 300][seed]
    rows = rng.integers(0, 2 if seed % 2 else 3, (n, width)).astype(np.uint8)
    ids = rng.integers(0, 12, n) if seed < 5 else np.arange(n)[::-1].copy()
    order, common = repeats.suffix_order(rows)
    same = lambda a, b: int(np.argmax(np.r_[rows[a] != rows[b], True]))
    expected = [max([same(i, j) for j in range(n) if ids[j] < ids[i]], default=0) for i in order]
    assert repeats.longest_previous_factors(ids[order], common).tolist() == expected
    capped = repeats.longest_previous_factors(ids[order], common, width)
    assert [c >= width for c in capped] == [e >= width for e in expected] and all(c >= e for c, e in zip(capped, expected))
    lowest = [min(ids[j] for j in range(n) if same(i, j) == width) for i in range(n)]
    assert repeats.first_documents(rows, ids).tolist() == lowest
