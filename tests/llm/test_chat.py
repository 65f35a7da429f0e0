import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from unitcast.llm import chat

PARTS = st.sampled_from([*chat._CONTROLS, "<", "[", "\\", "/", "s>", "INST]", "]", ">", " ", "\n", "x", "SYS>>", "</", "<\\/s>", "[\\[", "é"])
TEXT = st.lists(PARTS, max_size=10).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", "tool", ""]), TEXT), TEXT), max_size=5))
def test_any_content_round_trips(turns):
    out, spans = "", []
    for role, text in turns:
        piece, begin, end = chat.render_turn(role, text)
        if role == "assistant":
            spans.append((len(out) + begin, len(out) + end))
        out += piece
    assert [(chat.unescape(r), chat.unescape(t)) for r, t, _, _ in chat.parse(out)] == turns
    assert [chat.unescape(out[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_clean_texts_are_not_escaped():
    assert chat.render_turn("user", "if a < b [x] then") == ("[INST] if a < b [x] then [/INST]", 7, 24)


@pytest.mark.parametrize("bad", ["x", "[INST] a", "[INST] a</s>", "<s>a[/INST]", "[INST]a [/INST]", "[ROLE]r[/TEXT]", "</s>"])
def test_grammar_errors(bad):
    with pytest.raises(chat.GrammarError):
        chat.parse(bad)


def brute(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_odd_conversations(spark, chunk):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, None, None, None), (2, 1, "assistant", ""),
            (None, 0, "user", "x" * 200_000), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"),
            (3, 0, "t</s>ool", "\\<\\/s>")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, chunk int")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.read_back(chat.format_conversations(df.repartition(3), chunk)).collect()}
    exp = {c: brute([(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1:]))])
           for c in (1, 2, 3, None)}
    assert got == exp


def test_hot_conversation_is_cut_into_chunks(spark):
    df = spark.range(3000).selectExpr("5L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat('w ', 20) AS text")
    chunks = chat.format_conversations(df, 10_000)
    assert chunks.count() > 10
    row, = chat.read_back(chunks).collect()
    assert (row.n_turns, row.loss_chars) == (3000, 1500 * 40)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0
