import random
import re

import pytest

from lakeops.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, span):
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def run(docs, items, span, **how):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_leaks(docs, items, span, **how).collect()), key=str)


@pytest.mark.parametrize("span,limit", [(10, 8 << 20), (4, 0), (1, 8 << 20)])
def test_equals_brute_force(spark, span, limit):
    rng = random.Random(span)
    vocabulary = [f"w{i}" for i in range(6)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i % 17, text(rng.randint(0, 14))) for i in range(25)] + [(None, text(6)), (3, None)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), span, broadcast_bytes=limit)
    assert got == brute(docs, items, span)


def test_defined_cases(spark, hostile, no_docs):
    rows = [(r.doc_id, r.text) for r in hostile.select("doc_id", "text").collect()]
    items = [(1, "quick brown fox jumps over the LAZY dog, while seven wizards mix"), (2, "a b"), (2, "a b"), (3, ""), (None, "zero byte")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert run(hostile, frame, 10) == brute(rows, items, 10)
    assert run(no_docs, frame, 10) == []
    assert run(hostile, frame.limit(0), 10) == brute(rows, [], 10)
