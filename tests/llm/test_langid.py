import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeops.llm import langid


def slow_bits(texts, text, order):
    """PPM code length of ``text`` after counting ``texts``, straight from the definition."""
    follow = defaultdict(Counter)
    for t in texts:
        for i in range(len(t)):
            for k in range(order + 1):
                if i >= k:
                    follow[t[i - k:i]][t[i]] += 1
    bits = 0.0
    for i in range(len(text)):
        for k in range(min(order, i), -1, -1):
            seen = follow.get(text[i - k:i])
            if seen is None:
                continue
            n, q = sum(seen.values()), len(seen)
            if seen[text[i]]:
                bits -= math.log2(seen[text[i]] / (n + q))
                break
            bits -= math.log2(q / (n + q))
        else:
            bits += 8.0
    return bits


@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths(spark, order):
    teach = {"aa": [b"abracadabra", b"banana", b"x"], "bb": [b"the cat", b"a cat", b"zz"]}
    rows = [(i, t.decode(), lang) for lang, ts in teach.items() for i, t in enumerate(ts)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), order=order)
    texts = [b"banacat", b"q", b"the bra", b"abracadabra cat zz"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = model.bits(data, np.cumsum([len(t) for t in texts]))
    want = [[slow_bits(teach[name], t, order) for name in model.langs] for t in texts]
    assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predict(docs, langid.learn_from_folds(docs)).where(langid.fold() == 2).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) >= 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_defined_cases(spark, hostile, no_docs):
    model = langid.learn_from_folds(hostile)
    rows = langid.predict(hostile, model).collect()
    for r in rows:
        empty = not r.text or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == empty and (r.score == 0) == empty
        assert empty or r.lang_pred in model.langs
    assert len(rows) == hostile.count() and set(model.langs) <= {"en", "fr", "de"}
    assert langid.predict(no_docs, model).count() == 0
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.predict(hostile, nothing).collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.predict(hostile.withColumnRenamed("node", "score"), model)


def test_fitting_rows_are_bounded_and_whole(spark):
    rows = [(i, "ab" * 50, "en") for i in range(400)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), order=1, fitting_chars=5000)
    follow = dict(zip(model.keys[1].tolist(), model.cost[1][:, 0].tolist()))
    assert set(follow) == {(97 << 8) | 98, (98 << 8) | 97}
