import tiktoken
import public_tokenizers

import corpus_pipeline as pipeline
from lakeops.llm import bpe, decontaminate, langid
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_repeats import brute as cuts

SF = "/root/testdata/sf0.001"


def by_hand(spark, docs, sf_dir):
    """The rows that ``run`` must give, stage by stage from the definitions; only the language model is shared."""
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.learn_from_folds(docs)
    names, _ = model.predict([r.text for r in rows.values()])
    kept = [i for i, n in zip(rows, names) if n != "und"]
    groups = {i: c for i, _, c in classes([(i, rows[i].text) for i in kept], 5, 80)}
    kept = [i for i in kept if groups[i] == i]
    text = {i: b.decode("utf-8", "ignore") for i, _, _, b in cuts([(i, (rows[i].text or "").encode()) for i in kept], 50)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {i for i, _, n, _ in leaks(list(text.items()), items, 10) if n}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sorted((i, rows[i].lang, rows[i].source, len(text[i]), library.encode_ordinary(text[i])) for i in kept if i not in hit)


def test_run_equals_stages_by_hand(spark):
    got = pipeline.run(spark, SF).collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in got)
    want = by_hand(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert sorted((r.doc_id, r.lang, r.source, r.n_chars, r.ids) for r in got) == want
    assert 100 < len(want) < 200


def test_stages_take_hostile_rows(spark, hostile, no_docs):
    for docs in (hostile, no_docs):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "tokens":
                assert out.columns == docs.columns
            rows = out.collect()
            if docs is no_docs:
                assert rows == []
            elif name == "near_duplicates":
                ids = [r.doc_id for r in rows]
                assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 12, 13, 15, 16, 17, 18] and ids.count(None) == 2


def test_stage_functions_and_names():
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "benchmark_passages", "tokens"]
    assert pipeline.ORACLE_SQL is None and decontaminate.FILTER_BITS == 27


def test_short_clean_texts_stay(spark):
    """However many languages there are and however little a text tells them apart."""
    rows = [(i, f"{'abcdefghijkl'[i % 12] * 3} {'mnopqrstuvwx'[i % 12] * 4} text number", f"l{i % 12}") for i in range(240)]
    rows += [(1000, "a", None), (1001, "x y", "l1"), (1002, "12 !", "l1"), (1003, None, "l2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in pipeline.language(spark, docs, SF).collect()}
    assert kept == {i for i, *_ in rows} - {1002, 1003}
