import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import toxicity
from lakeops.llm.queries import op12_toxicity


def brute_parts(piece: bytes) -> dict:
    """Weighted triples of one piece by their definition."""
    s = bytes([0]) + piece + bytes([0])
    out: dict = {}
    for i, j, k in itertools.combinations(range(len(s)), 3):
        if k - i <= toxicity.REACH and 0 not in s[i + 1:k]:
            u = s[i] << 12 | s[j] << 6 | s[k]
            out[u] = out.get(u, 0.0) + float(toxicity.DECAY) ** (k - i + 1)
    norm = np.sqrt(sum(float(toxicity.DECAY) ** (2 * (k - i + 1)) for i, j, k in itertools.combinations(range(len(s)), 3) if k - i <= toxicity.REACH))
    return {u: v / max(norm, 1e-4) for u, v in out.items()}


def random_pieces(seed, count=40):
    rng = random.Random(seed)
    return [bytes(rng.choice([1, 2, 3, 30, 57]) for _ in range(rng.randint(1, 12))) for _ in range(count)]


def test_kernel_parts_equal_definition():
    pieces = random_pieces(1)
    piece, triple, value = toxicity.kernel_parts(pieces)
    for i, p in enumerate(pieces):
        got = {int(u): v for u, v in zip(triple[piece == i], value[piece == i])}
        expected = brute_parts(p)
        assert set(got) == set(expected) and all(abs(got[u] - expected[u]) < 1e-5 for u in got)


def test_margins_equal_landmark_sum():
    """The weights of triples give, for every piece, the sum over landmarks of coefficient times kernel."""
    marks, pieces = random_pieces(2, 6), random_pieces(3)
    beta = np.random.default_rng(5).normal(size=len(marks))
    weights = np.zeros(1 << 18, np.float32)
    for b, mark in zip(beta, marks):
        for u, v in brute_parts(mark).items():
            weights[u] += b * v
    got, _ = toxicity.margins(toxicity._as_buffer(pieces), weights, 0.25, toxicity.norms(4))
    for g, p in zip(got, pieces):
        own = brute_parts(p)
        assert abs(g - 0.25 - sum(b * sum(v * own.get(u, 0.0) for u, v in brute_parts(m).items()) for b, m in zip(beta, marks))) < 1e-4


def test_pieces():
    def cut(text):
        s, _ = toxicity.symbols([text])
        return [bytes(p) for p in s.tobytes().split(b"\0") if p]

    word = lambda w: bytes(ord(c) - 96 for c in w)
    assert cut("An Idiot, (fool)!") == [word("an"), word("idiot"), word("fool")]
    assert cut("i d i o t") == cut("i.d.i.o.t") == cut("IDIOT") == [word("idiot")]
    assert cut("a fine\nb day") == [word("a"), word("fine"), word("b"), word("day")]
    assert cut("") == cut(" \n\t") == []
    s, begins = toxicity.symbols(["x y z", "", "q"])
    assert [bytes(s[a:b]).count(word("xyz")) for a, b in zip(begins, begins[1:])] == [1, 0, 0]


def corpus(count, seed, odd=lambda w, rng: w):
    """Invented prose; toxic texts hold one or two of a few words."""
    rng = random.Random(seed)
    syllables = ["ta", "re", "mo", "lin", "ver", "so", "ka", "den", "pu", "is"]
    insults = ["blorgun", "skraddle", "vumpex"]
    texts, toxic = [], []
    for i in range(count):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 60))]
        if i % 4 == 0:
            for _ in range(rng.randint(1, 2)):
                words.insert(rng.randrange(len(words)), odd(rng.choice(insults), rng))
        texts.append(" ".join(words) + ".")
        toxic.append(i % 4 == 0)
    return texts, toxic


@pytest.fixture(scope="module")
def machine():
    return toxicity.train(*corpus(400, 1))


def test_held_out_accuracy(machine):
    texts, toxic = corpus(300, 2)
    found = machine.scores(texts) >= 0.7
    assert (found == np.array(toxic)).mean() > 0.99


@pytest.mark.parametrize("odd", [lambda w, r: " ".join(w), lambda w, r: ".".join(w), lambda w, r: w.upper() + "!",
                                 lambda w, r: w[:4] + r.choice("xyz") + w[4:], lambda w, r: w[:3] + w[2:]])
def test_gapped_insults(machine, odd):
    """Spelt-out insults and insults with one more character rank before clean texts."""
    texts, toxic = corpus(200, 3, odd)
    score = machine.scores(texts)
    bad, clean = score[np.array(toxic)], score[~np.array(toxic)]
    assert (bad[:, None] > clean[None, :]).mean() > 0.97


def test_scores_do_not_depend_on_grouping(machine):
    texts, _ = corpus(30, 4)
    assert np.allclose(machine.scores(texts), np.concatenate([machine.scores([t]) for t in texts]), atol=1e-6)


def test_fit_and_score(spark, hostile, no_docs):
    texts, toxic = corpus(300, 5)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)] + [(1, 0), (None, 1), (2, None), (3, 7)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    assert np.mean([(got[i] >= 0.7) == t for i, t in enumerate(toxic)]) > 0.99
    found = {(r.doc_id, r.text): r.score for r in toxicity.score(hostile, machine).collect()}
    assert len(found) == hostile.distinct().count() and all(0 <= s < 0.7 for s in found.values())
    assert toxicity.score(no_docs, machine).collect() == []
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert nothing is None and {r.score for r in toxicity.score(hostile, nothing).collect()} == {0.0}
    assert toxicity.fit(no_docs, labels) is None
    with pytest.raises(ValueError):
        toxicity.score(hostile.withColumn("score", F.lit(1)), machine)


def test_query(spark):
    out = op12_toxicity(spark, "/root/testdata/sf0.01")
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    marked = out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic is not null"), "doc_id").where("held_out").collect()
    toxic, clean = [r.score for r in marked if r.toxic == 1], [r.score for r in marked if r.toxic == 0]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.75
    assert np.mean([r.predicted for r in marked if r.toxic == 0]) < 0.05
