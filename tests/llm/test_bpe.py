import random

import public_tokenizers
import pytest
import tiktoken

from lakeops.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 40])
def test_tree_equals_library(leaf):
    rng = random.Random(leaf)
    own = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, leaf, cache_entries=50)
    letters = "ab 'sretlvdm\n\t  éçß123.,!中文aaaa    😀"
    for k in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))
        if k % 5 == 0:
            text = rng.choice(["a", "é", "-", " ", "ab", "'re"]) * rng.randint(1, 700)
        ids = own.encode(text)
        assert ids.tolist() == LIBRARY.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_rows(spark, hostile, no_docs):
    out = bpe.encode_decode(hostile, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, leaf_chars=64)
    want = [(r.doc_id, r.text or "") for r in hostile.collect()]
    got = [(r.doc_id, r.ids, bytes(r.decoded)) for r in out.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    assert sorted(got, key=key) == sorted(((i, LIBRARY.encode_ordinary(t), t.encode()) for i, t in want), key=key)
    assert out.columns == [c for c in hostile.columns if c != "text"] + ["ids", "decoded"]
    assert bpe.encode_decode(no_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_decode(out.selectExpr("ids", "cast(doc_id as string) as text"), "x", "x")
