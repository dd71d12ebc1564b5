import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm import infill


def brute(doc_id, text, keep=90, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= keep:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def run(df, **how):
    done = infill.restore(infill.transform(df, **how))
    return sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in done.collect()), key=str)


@pytest.mark.parametrize("limit,keep,spm", [(8 << 20, 90, 20), (64, 90, 20), (8 << 20, 100, 50)])
def test_equals_brute_force(spark, monkeypatch, limit, keep, spm):
    monkeypatch.setattr(infill, "GROUP_BYTES", limit)
    rng = random.Random(limit)
    rows = [(i, "".join(rng.choice("ab Zé<>PSM€𝄞\n") for _ in range(rng.randint(0, 40)))) for i in range(400)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), keep_share=keep, spm_share=spm) == sorted((brute(*r, keep, spm) for r in rows), key=str)


def test_defined_cases(spark, hostile, no_docs):
    rows = [(r.doc_id, r.text) for r in hostile.select("doc_id", "text").collect()]
    assert run(hostile) == sorted((brute(*r) for r in rows), key=str)
    assert run(no_docs) == []
    assert set(hostile.columns) < set(infill.transform(hostile).columns)
    for name, function in (("n", infill.transform), ("restored", lambda df: infill.restore(df.withColumnsRenamed({"text": "output", "found": "form"})))):
        with pytest.raises(ValueError):
            function(hostile.withColumn(name, F.lit(1)))


def test_outputs_not_of_their_form_are_null(spark):
    rows = [("psm", "<P>a<S>c<M>b", "abc"), ("spm", "<S>c<P>a<M>b", "abc"), ("psm", "<S>c<P>a<M>b", None), ("psm", "x<P>a<S>c<M>b", None),
            ("psm", "<P>a<S>c", None), ("plain", "<P>", "<P>"), ("other", "abc", None), (None, "abc", None), ("plain", None, None), ("psm", "", None)]
    got = infill.restore(spark.createDataFrame(rows, "form string, output string, expected string")).collect()
    assert [(r.form, r.output, r.restored) for r in got] == rows
