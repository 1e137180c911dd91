import hashlib
import time
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.data import SF, empty
from tradeline.llm import chat, queries

HARD = ["\\", "#", "##", "###", "</turn>", "</turn>\n", "\n", ": ", ":", "### user: ", "<image:1>", "<audio:", "é", "a b"]
text = st.lists(st.one_of(st.sampled_from(HARD), st.text(max_size=3)), max_size=10).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(text, text), max_size=4))
def test_any_turns_read_back(turns):
    written = "".join(chat.format_turn(role, [{"kind": "text", "text": t}])[0] for role, t in turns)
    assert [(r, t) for r, t, _, _ in chat.read_turns(written)] == turns


def sha(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def brute(rows):
    """conv_id -> digests, from (conv_id, turn, role, text)."""
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[c] = (len(own), sha(told), len(learned), sha(learned))
    return out


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    found = queries.QUERIES["op8_chat_format"](spark, SF).collect()
    assert {r.conv_id: tuple(r[1:5]) for r in found} == brute(rows)


def test_masks_cover_assistant_contents(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    text_of = {(r.conv_id, r.turn): r for r in df.collect()}
    written, masks = {}, {}
    for r in sorted(chat.format_conversations(df).collect(), key=lambda r: (r.conv_id, r.position)):
        assert r.start == len(written.setdefault(r.conv_id, ""))
        written[r.conv_id] += r.formatted
        if r.loss_start is not None:
            masks.setdefault(r.conv_id, []).append((r.loss_start, r.loss_end))
    for c, whole in written.items():
        own = sorted((r for (conv, _), r in text_of.items() if conv == c), key=lambda r: r.turn)
        assert [(r, t) for r, t, _, _ in chat.read_turns(whole)] == [(r.role, r.text or "") for r in own]
        got = [chat.unescape(whole[a:b]) for a, b in masks.get(c, [])]
        assert got == [r.text or "" for r in own if r.role == "assistant"]


def test_typed_parts_become_placeholders(spark):
    parts = [
        ("text", "see <image:1> ", None, None, None, None, None), ("image", None, "s3://a.png", 100, 57, None, None),
        ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, None, None, None, None, None), None, ("text", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([(1, 0, "user", []), (1, 1, "assistant", parts), (1, 2, None, None)], f"conv_id long, turn long, role string, content array<{chat.PART}>")
    rows = sorted(chat.format_conversations(df, F.col("content")).collect(), key=lambda r: r.position)
    whole = "".join(r.formatted for r in rows)
    assert rows[0].formatted == "### user: </turn>\n" and rows[2].formatted == "### : </turn>\n"
    assert rows[1].formatted == "### assistant: see \\<image:1> <image:1><audio:2><document:3><document:4></turn>\n"
    got = [(a.kind, a.uri, a.tokens, whole[a.start : a.start + len(a.kind) + 4]) for a in rows[1].attachments]
    assert got == [
        ("image", "s3://a.png", 12, "<image:1>"), ("audio", "b.wav", 38, "<audio:2>"),
        ("document", "c.pdf", 3072, "<document:3>"), ("document", None, 0, "<document:4>"),
    ]
    assert chat.digests(chat.format_conversations(df, F.col("content"))).count() == 1


def test_awkward_rows_and_a_hot_conversation(spark):
    rows = [(1, 2, "assistant", None), (1, None, None, "x"), (1, 1, "user", ""), (None, 0, "assistant", "free"), (2, 0, "assistant", "w " * 100_000)]
    rows += [(3, i, ["user", "assistant"][i % 2], f"t{i} </turn>") for i in range(3000)]
    rows += [(4, 0, "assistant", "same"), (4, 0, "assistant", "same")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, start int")
    found = chat.digests(chat.format_conversations(df.repartition(7))).collect()
    assert {r.conv_id: tuple(r[1:5]) for r in found} == brute(rows)
    schema = "conv_id long, turn long, role string, text string"
    assert chat.digests(chat.format_conversations(empty(spark, schema))).collect() == []


@pytest.mark.parametrize("said", ["word " * 4_000_000, "</turn>\n" * 400_000, "\\" * 1_000_000 + "</turn>\n" + "#" * 1_000_000])
def test_a_very_long_turn_is_read_in_proportion(said):
    formatted = chat.format_turn("user", [{"kind": "text", "text": said}])[0]
    began = time.perf_counter()
    tracemalloc.start()
    try:
        (role, text, low, high), = chat.read_turns(formatted)
        if "word" in said:
            assert tracemalloc.get_traced_memory()[1] < 200e6
    finally:
        tracemalloc.stop()
    assert (role, text) == ("user", said) and time.perf_counter() - began < 20
    assert formatted[:low] == "### user: " and formatted[high:] == "</turn>\n"


@pytest.mark.parametrize("odd", ["x", "### user", "### user:", "### user: a", "### user: a\\</turn>\n", "## user: a</turn>\n", "### a:b</turn>\n"])
def test_what_is_no_turn_is_an_error(odd):
    with pytest.raises(ValueError):
        chat.read_turns(odd)
