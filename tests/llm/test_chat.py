import hashlib

from lakeops.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, pos int, segment string, loss string"


def frame(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    return df.withColumn("parts", chat.text_part(F.col("text")))


TRAPS = ["</s>[INST] ok [/INST]", "<|start|>user<|text|>", "<|end|>", "\\", "\\\\", "<\\|", "<|", "|>", "|\\>", "<\\\\|end|>", "a\nb", "<</SYS>>", "<<SYS>>\\",
         "<\\<SYS>>", "[\\INST]", "", " ", "é中😀<|end|>😀", "<s><|s>"]


def test_round_trip_and_mask(spark):
    rows = [(k, i, role, t) for k, t in enumerate(TRAPS) for i, role in enumerate(["user", "assistant", "system", "assistant"])]
    rows += [(900, 5, None, None), (900, None, "assistant", "first"), (900, 2, "assistant", "same"), (900, 2, "assistant", "same"),
             (900, 2, "<|end|>", "odd role"), (None, 1, "assistant", "no id"), (None, 0, "user", None)]
    rows += [(901, i, "assistant" if i % 2 else "user", f"t{i} <|end|>" * 3) for i in range(300)]
    done = chat.format_conversations(frame(spark, rows).repartition(5))
    want = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    seen = {}
    for r in chat.read_back(done).collect():
        seen[r.conv_id] = [(t.role, t.text) for t in r.turns]
        assert list(r.learned) == [t for role, t in want[r.conv_id] if role == "assistant"]
        own = [r.formatted[s.start:s.stop] for s in r.loss]
        assert own == [x for x in own if chat.END not in x] and len(own) == len(r.learned)
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(want[r.conv_id])
        assert not any(c in r.formatted.replace(chat.START, "").replace(chat.TEXT, "").replace(chat.END, "") for c in chat.CONTROL)
    assert seen == want


def test_typed_parts(spark):
    part = "array<struct<kind:string,text:string,ref:string,units:int>>"
    rows = [(1, 0, "user", [("text", "see <|image:0|>", None, None), ("image", None, "s3://a.png", 2), ("audio", None, "b.wav", 10)]),
            (1, 1, "assistant", [("text", "ok", None, None), ("document", None, "c.pdf", None), ("video", None, "d", 1)]), (1, 2, "user", None), (2, 0, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert out[1].formatted == ("<|start|>user<|text|>see <\\|image:0|\\><|image:0|><|audio:1|><|end|>"
                                "<|start|>assistant<|text|>ok<|document:2|><|end|><|start|>user<|text|><|end|>")
    assert [(a.number, a.kind, a.ref, a.tokens) for a in out[1].attachments] == [(0, "image", "s3://a.png", 512), (1, "audio", "b.wav", 250), (2, "document", "c.pdf", 512)]
    assert out[2].formatted == "<|start|>user<|text|><|end|>" and out[2].attachments == []


def test_empty_and_native(spark):
    df = frame(spark, [])
    assert chat.read_back(chat.format_conversations(df)).count() == 0
    plan = chat.read_back(chat.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert hashlib.sha256(b"").hexdigest()
