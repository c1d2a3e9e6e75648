import hashlib

from blocklot.llm import chat

ROWS = [(1, 0, "system", "be & <kind>"), (1, 2, "assistant", "&lt; </turn> &amp;\n<turn:user>"), (1, 1, "user", None),
        (1, 3, "assistant", ""), (2, 0, "us<er>", "é😀" * 20_000), (2, None, None, "first"), (None, 0, "user", "x"),
        (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (-7, 0, "user", r"\### Assistant: </turn> ok"),
        (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted([(-1 if t is None else t, r or "", x or "") for k, t, r, x in rows if k == c])
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, row string, parts int")


def test_read_back_equals_brute_force(spark):
    got = chat.digests(chat.format_conversations(chat.text_parts(table(spark, ROWS).repartition(3)))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(ROWS)


def test_control_strings_stand_only_where_the_template_put_them(spark):
    row = chat.format_conversations(chat.text_parts(table(spark, ROWS))).where("conv_id = 1").first()
    assert row.formatted.count("</turn>") == 4 and row.formatted.count("<") == 8
    assert [s.turn for s in row.loss] == [2, 3]


def test_typed_parts_become_placeholders_in_order(spark):
    parts = [("text", "see <this>", None, None, None, None, None), ("image", None, "a.png", 600, 500, None, None),
             ("audio", None, "b.wav", None, None, 2.5, None), ("text", None, None, None, None, None, None),
             ("document", None, "c.pdf", None, None, None, 3), ("video", None, "d.mp4", None, None, None, None),
             (None, None, None, None, None, None, None), ("image", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 1, "user", parts), (1, 2, "assistant", [("image", None, "e.png", 512, 512, None, None)]),
                                (1, 3, "assistant", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_conversations(df).first()
    first = "see &lt;this&gt;<image><audio><document><other><other><image>"
    assert row.formatted == (f"<turn:user>{first}</turn>\n<turn:assistant><image></turn>\n<turn:assistant></turn>\n")
    assert [(a.turn, a.type, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", "a.png", 512), (0, "audio", "b.wav", 63), (0, "document", "c.pdf", 3072), (0, "video", "d.mp4", 0),
        (0, None, None, 0), (0, "image", None, 0), (1, "image", "e.png", 256)]
    assert row.expanded_tokens == 512 + 63 + 3072 + 256
    assert row.formatted.count("<image>") + row.formatted.count("<audio>") + row.formatted.count("<document>") + \
        row.formatted.count("<other>") == len(row.attachments)


def test_empty_table_and_native_plan(spark):
    assert chat.digests(chat.format_conversations(chat.text_parts(table(spark, [])))).count() == 0
    plan = chat.op9_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
