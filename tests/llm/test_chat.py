"""Operator 8: round trips, typed parts, and the query against its SQL."""

import hashlib

from compare import bag, duck

from gridspark.llm import chat, queries

SF = "/root/testdata/sf0.001"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>x<|text|>", "\\<\\[", "a\\", "<<[[\\\\", "", "tab\tä漢😀", "$1 \\$2"]


def turns(spark, *rows):
    return spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")


def test_texts_come_back_and_hold_no_control_string(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(NASTY)] + [(1, 99, "<|end|>\n", None)]
    formatted = chat.format_turns(turns(spark, *rows), chat.text_parts())
    got = chat.parsed(formatted).orderBy("position").collect()
    assert [(r["role"], r["text"]) for r in got] == [(r, t or "") for _, _, r, t in rows]
    for r in got:
        inside = r["formatted"].removeprefix(chat.TURN).removesuffix(chat.END + "\n").replace(chat.TEXT, "", 1)
        for mark in (chat.TURN, chat.TEXT, chat.END, "</s>", "[INST]", "[/INST]"):
            assert mark not in inside
        assert r["learned"] == (r["text"] if r["role"] == "assistant" else "")


def test_nulls_ties_and_repeats_have_an_order(spark):
    rows = [(None, 1, "user", "x"), (2, None, "user", "b"), (2, None, "user", "a"), (2, 0, None, "c"), (2, 0, None, "c")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(turns(spark, *rows), chat.text_parts())).collect()}
    want = "".join(f"{r}\n{t}\n" for r, t in [("user", "a"), ("user", "b"), ("", "c"), ("", "c")])
    assert got[2]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert got[2]["n_turns"] == 4 and got[2]["loss_chars"] == 0 and got[None]["n_turns"] == 1


def test_no_rows(spark):
    assert chat.digests(chat.format_turns(turns(spark), chat.text_parts())).collect() == []


def test_typed_parts_become_ordered_placeholders(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [
            (1, 0, "user", [("image", None, "a.png", 4.0), ("text", "see <it>", None, None), ("AUDIO", None, "b.wav", 2.5)]),
            (1, 1, "assistant", [("document", None, "c.pdf", None), (None, "done", None, None), ("video", "?", None, None)]),
            (1, 2, "user", None),
        ],
        f"conv_id long, turn long, role string, parts {chat.PARTS}",
    )
    got = chat.format_turns(df, F.col("parts")).orderBy("position").collect()
    assert got[0]["formatted"] == "<|turn|>user<|text|><|image:1|>see <\\it><|audio:2|><|end|>\n"
    assert got[1]["formatted"] == "<|turn|>assistant<|text|><|document:3|>done?<|end|>\n"
    assert got[2]["formatted"] == "<|turn|>user<|text|><|end|>\n"
    assert [tuple(a) for a in got[0]["attachments"]] == [(1, "image", "a.png", 4 * 256), (2, "audio", "b.wav", 63)]
    assert [tuple(a) for a in got[1]["attachments"]] == [(3, "document", "c.pdf", 600)]
    assert [r["n_tokens"] for r in got] == [1024 + 63, 600, 0]
    line = got[1]["formatted"]
    assert line[got[1]["loss_begin"] : got[1]["loss_end"]] == "<|document:3|>done?"


def test_op8_and_its_sql(spark):
    df = queries.QUERIES["op8_chat_format"](spark, SF)
    result = duck(SF).execute(queries.ORACLES["op8_chat_format"])
    names = [c[0] for c in result.description]
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(names, result.fetchall())
