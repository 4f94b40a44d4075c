"""Chat formatting: round trip, mask and digests against plain Python."""

from __future__ import annotations

import hashlib

from kinetra.llm import chat

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "assistant", "again"), (1, 3, "user", None),
    (2, 5, "system", "<|turn|>user<|body|>x<|end|>"), (2, 6, "assistant", "<\\|end|> <\\\\|next|> <|<|| <"),
    (2, 7, "user", "<"), (2, 8, "user", "|end|>"), (2, 9, "assistant", "日本 ẞ\n\n\r"),
    (3, 0, "assistant", ""), (3, 1, "assistant", ""), (4, 0, "user", ""),
    (5, 1, "b", "tie"), (5, 1, "a", "tie"), (5, 1, "a", "tie"), (5, 0, None, "no role"),
    (6, 0, "odd<|body|>\nrole", "t"), (7, 0, "user", "long " * 50_000), (None, 0, "user", "n"),
    (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        spelled = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), sha(spelled), len(loss), sha(loss))
    return out


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA + ", turns string, pieces int")
    formatted = chat.format_conversations(df.repartition(3))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.read_back(formatted)).collect()}
    assert got == plain(ROWS)
    text = {r.conv_id: r for r in formatted.collect()}
    assert text[1].formatted == ("<|turn|>user<|body|>hi<|end|><|turn|>assistant<|body|>hello<|next|>again"
                                 "<|end|><|turn|>user<|body|><|end|>")
    # control strings occur as often as the template writes them
    assert text[2].formatted.count("<|end|>") == 4 and text[2].formatted.count("<|next|>") == 1
    for r in text.values():
        marked = "".join(r.formatted[s.start:s.start + s.chars] for s in r.loss_spans)
        assert not any(c in marked for c in (chat.TURN, chat.BODY, chat.NEXT, chat.END))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.read_back(chat.format_conversations(df))).count() == 0


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = chat.digest(chat.read_back(chat.format_conversations(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
