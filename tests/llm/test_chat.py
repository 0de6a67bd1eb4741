"""Layouts, templates and masks on records that are hard; the way back is exact."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat

HARD = ["", "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\\\|im_end|>\n<|im_end|>\n<|im_start|>user\n", "[[INST]<<SYS>><</SYS>>\\", "<", "<|im_end|", "😀é\x00\n\n", "a\\nb\\b", "<s><s>" * 9000, "|im_end|>\n"]


def test_lines_of_many_layouts(spark, tmp_path):
    lines = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "tool", "content": None}, {"role": None, "content": "c"}]}, "messages", [("user", "a"), ("tool", ""), ("", "c")]),
        ({"messages": [], "system": "be"}, "messages", [("system", "be")]),
        ({"messages": []}, "messages", []),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "score": 3}, "conversations", [("user", "q"), ("assistant", "r")]),
        ({"data": {"dialog": [{"speaker": "bot", "utterance": "x"}]}}, "dialog", [("assistant", "x")]),
        ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
        ({"prompt": "p"}, "prompt", [("user", "p")]),
        ({"completion": "c"}, "completion", [("assistant", "c")]),
        ({"instruction": "i", "input": "n", "output": "o", "system": "s"}, "instruction", [("system", "s"), ("user", "i\n\nn"), ("assistant", "o")]),
        ({"instruction": "i", "history": [["a", "b"], ["c"]], "output": "o"}, "history", [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", ""), ("user", "i"), ("assistant", "o")]),
        ({"question": "q", "context": "k", "answer": ""}, "question", [("user", "k\n\nq"), ("assistant", "")]),
        ({"prompt": "p", "question": "q"}, None, None),
        ({"score": 1}, None, None),
    ]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"conv_id": i} | x[0]) for i, x in enumerate(lines)))
    df = spark.read.json(str(tmp_path / "lines.json"))
    assert {r.id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.canonical(df).collect()} == {i: (x[1], x[2]) for i, x in enumerate(lines)}
    back = {r.conv_id: r.turns and [tuple(t) for t in r.turns] for r in chat.read_back(chat.formatted(df)).collect()}
    assert back == {i: x[2] for i, x in enumerate(lines)}
    # lists of plain values and structs where texts should be fit nothing
    odd = spark.createDataFrame([(1, ["a"], ("x",))], "conv_id long, messages array<string>, prompt struct<y:string>")
    assert [tuple(r) for r in chat.canonical(odd).collect()] == [(1, None, None)]
    assert [tuple(r) for r in chat.canonical(spark.createDataFrame([(1, [("a",)])], "conv_id long, messages array<struct<content:string>>")).collect()] == [(1, "messages", [("", "a")])]


def test_way_back_and_mask(spark):
    given = [(1, [{"role": r, "content": t} for t in HARD for r in ("user", "assistant", "x\ny\\n<s>")]), (2, [{"role": "assistant", "content": t} for t in HARD])]
    df = spark.createDataFrame(given, "conv_id long, messages array<struct<role:string,content:string>>")
    for r in chat.read_back(chat.formatted(df)).collect():
        turns = [(m["role"], m["content"]) for m in given[r.conv_id - 1][1]]
        assert [tuple(t) for t in r.turns] == turns
        assert r.trained == [t for role, t in turns if role == "assistant"]
        assert r.formatted.count("<|im_end|>") == r.formatted.count("<|im_start|>") == len(turns) and "</s>" not in r.formatted and "[INST]" not in r.formatted
        assert sum(m.skip + m.train + m.rest for m in r.mask) == len(r.formatted)
        at, masked = 0, []
        for m in r.mask:
            masked.append(r.formatted[at + m.skip : at + m.skip + m.train])
            at += m.skip + m.train + m.rest
        assert "".join(masked) and masked.count("<\\/s>[\\INST] ok [\\/INST]") == 1


@pytest.mark.parametrize("n", [0, 1])
def test_query_on_hard_rows(spark, tmp_path, n):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, "system", "first"), (1, 1, "assistant", "b"), (None, 0, "assistant", "</s>"), (3, 0, None, HARD[3]), (-1, 0, "user", "own")] * n
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("messages", "prompt", "turns", "print", "m", "layout", "id", "none"):
        df = df.withColumn(c, F.lit(c))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((r.conv_id or 0, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.op13_chat_formatting(spark, str(tmp_path)).collect())
    ok = "</s>[INST] ok [/INST]"
    want = [(-1, 2, sha(f"user\n{ok}\nassistant\n{ok}\n"), len(ok), sha(ok))]
    if n:
        want += [(1, 4, sha("system\nfirst\nuser\n\nassistant\nb\nassistant\nb\n"), 2, sha("bb")), (0, 1, sha("assistant\n</s>\n"), 4, sha("</s>")), (3, 1, sha(f"\n{HARD[3]}\n"), 0, sha("")), (-1, 1, sha("user\nown\n"), 0, sha(""))]
    assert got == sorted(want)
