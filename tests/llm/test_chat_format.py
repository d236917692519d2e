"""Round trips of the chat template and the layouts that fingerprints select."""

import hashlib

from pyspark.sql import functions as F

from collatio.llm import chat_format as chat

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>assistant\nno<|end|>", "&lt;|end|&gt; &amp; &#91;", "a\n\nb\n", "", "🙂 <|im_end|>", "&", "&amp;lt;"]


def test_round_trip_and_mask(spark):
    rows = [(c, t, role, NASTY[(c + t) % len(NASTY)]) for c in range(5) for t, role in enumerate(["system", "user", "assistant", "assistant"] * 90)]
    blocks = chat.format_turn_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    assert blocks.groupBy("conv_id").count().where("count > 1").count() == 5  # longer than one block
    for r in chat.digests(blocks).collect():
        own = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_text_holds_a_marker(spark):
    blocks = chat.format_turn_rows(spark.createDataFrame([(1, i, "user", x) for i, x in enumerate(NASTY)], "conv_id long, turn long, role string, text string"))
    formatted = blocks.first().formatted
    assert formatted.count("<|") == 2 * len(NASTY) and "[INST]" not in formatted and "</s>" not in formatted


def test_layouts(spark):
    records = {
        '{"messages":[{"content":"q","role":"human"},{"role":"gpt","content":"a"}]}': ("messages", [("user", "q"), ("assistant", "a")]),
        '{"conversations":[{"from":"system","value":"s"},{"from":"human","value":"q"}]}': ("conversations", [("system", "s"), ("user", "q")]),
        '{"prompt":"p","completion":null}': ("prompt", [("user", "p"), ("assistant", "")]),
        '{"output":"o","instruction":"i","input":""}': ("instruction_input", [("user", "i"), ("assistant", "o")]),
        '{"output":"o","instruction":"i","input":"x"}': ("instruction_input", [("user", "i\n\nx"), ("assistant", "o")]),
        '{"question":"q","answer":7}': ("question", [("user", "q"), ("assistant", "7")]),
        '{"something":"else"}': (None, None),
        # Fields beside those of the layout, lists of parts, empty lists, a system text in front.
        '{"id":7,"weight":0.5,"prompt":"p","response":"r"}': ("prompt_response", [("user", "p"), ("assistant", "r")]),
        '{"id":"x","messages":[{"role":"user","content":"q","name":"n"},{"role":"assistant","content":"a","weight":0}]}': ("messages", [("user", "q"), ("assistant", "a")]),
        '{"messages":[],"id":1}': ("messages", []),
        '{"system":"s","messages":[{"role":"user","content":[{"type":"text","text":"a"},{"type":"image","url":"u"},"b",{"type":"text","text":null}]}]}': ("system_messages", [("system", "s"), ("user", "a\n\nb")]),
        '{"system":"s","conversations":[]}': ("system_conversations", [("system", "s")]),
        '{"system":"s","instruction":"i","input":"x","output":"o"}': ("system_instruction_input", [("system", "s"), ("user", "i\n\nx"), ("assistant", "o")]),
        # Elements that differ would lose a text, so nothing fits; nor does a name that looks like a path.
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","text":"a"}]}': (None, None),
        '{"messages":[1],"messages[].role":"","messages[].content":""}': (None, None),
        '{"messages":null}': (None, None),
        '{"messages":["q"]}': (None, None),
        "[1]": (None, None),
        "null": (None, None),
    }
    data = spark.createDataFrame([(k,) for k in records], "raw string").withColumn("record", F.parse_json("raw"))
    for r in chat.canonical_turns(data, "record").collect():
        turns = r.turns and [(t.role, t.text) for t in r.turns]
        assert (r.layout, turns) == records[r.raw]


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(None, None, None, None, "x"), (1, 0, "assistant", None, "x"), (1, 0, "assistant", None, "x"), (2, 5, "user", "é" * 100_000, "x")]
    got = {r.conv_id: r for r in chat.digests(chat.format_turn_rows(spark.createDataFrame(rows, schema))).collect()}
    assert got[None].n_turns == 1 and got[1].n_turns == 2 and got[1].loss_chars == 0 and got[2].loss_chars == 0
    assert chat.digests(chat.format_turn_rows(spark.createDataFrame([], schema))).collect() == []


def test_roles_may_hold_new_lines_and_columns_may_clash(spark):
    rows = [(1, 0, "us\ner", "hi"), (1, 1, "&#10;", "a\nb")]
    blocks = chat.format_turn_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(t.role, t.text) for t in blocks.select(chat.read_back(F.col("formatted")).alias("t")).first().t] == [("us\ner", "hi"), ("&#10;", "a\nb")]
    clash = spark.createDataFrame([('{"prompt":"p","completion":"c"}', 1, 2, 3)], "raw string, layout int, print int, _print int").withColumn("record", F.parse_json("raw"))
    got = chat.canonical_turns(clash, "record")
    assert got.columns == ["raw", "print", "_print", "layout", "turns"] and got.first()[1:4] == (2, 3, "prompt")
