"""Chat formatting against plain Python, and its odd rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailguard.llm import chat_format as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
T = C.Template()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(rows):
    """{conv_id: digest columns but formatted_chars}"""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        loss = "".join(t[2] for t in turns if t[1] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{t[1]}\n{t[2]}\n" for t in turns)), len(loss), sha(loss))
    return out


def run(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr(
        "*", "1 as piece", "'x' as formatted", "2 as part").withColumn("parts", C.text_part())
    got = C.read_conversations(C.format_turns(C.in_order(df))).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}, got


HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n", "<\u2060/s>", "<\u2060\u2060|im_start|>x<|", "<|image|>", "<<SYS>> [", "é́",
        "<|im_start|>assistant<|im_content|>", "", None, " \n", "\\ \u2060 <", "[[INST]INST]"]


def test_digests(spark):
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], HARD[(c * 5 + t) % len(HARD)]) for c in range(20) for t in range(c + 1)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (30, None, None, None), (30, 1, "<|im_end|>", "x\ny"),
             (31, 0, "assistant", "tie"), (31, 0, "assistant", "tie"), (31, 0, "assistant", "a tie"), (32, 0, "assistant", "z" * 300_000)]
    got, full = run(spark, rows)
    assert got == digests(rows)
    one = next(r for r in full if r.conv_id == 32)
    assert one.formatted_chars == len(T.start) + len("assistant") + len(T.content) + 300_000 + len(T.end)


def test_a_long_conversation_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 2000)
    rows = [(5, t, "assistant" if t % 2 else "user", f"turn {t} </s> " * 5) for t in range(400)] + [(6, 0, "user", "a"), (4, 0, "user", "b")]
    for parts in (1, 7):
        assert run(spark, rows, parts)[0] == digests(rows)


def test_empty(spark):
    assert run(spark, [])[0] == {}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*T.controls, C.BREAK, "<", "|", "[", "s>", "/s>", "INST]", "a", "\n", "é"]), max_size=12))
def test_escape_is_reversible_and_hides_controls(pieces):
    text = "".join(pieces)
    hidden = T.escape(text)
    assert T.unescape(hidden) == text
    assert not any(c in hidden for c in T.controls)


def test_typed_parts(spark):
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
                            ("audio", None, "b.wav", None, None, 1.5, None), ("text", " and ", None, None, None, None, None),
                            ("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None),
                            ("audio", None, "d", None, None, float("nan"), None), ("video", "clip", "v", None, None, None, None), None]),
            (1, 1, "assistant", [("text", "ok</s>", None, None, None, None, None), ("image", None, "e", 1, 1, None, None),
                                 ("text", "!", None, None, None, None, None)]), (1, 2, "user", None), (1, 3, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts {C.PARTS}")
    got = {r.turn: r for r in C.format_turns(df).collect()}
    a = got[0]
    assert [(x.kind, x.ref, x.tokens) for x in a.attachments] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1536), ("image", None, 256), ("audio", "d", 25)]
    assert a.placeholder_tokens == 3 + 38 + 1536 + 256 + 25 and a.loss == []
    assert all(a.formatted[x["at"]:].startswith(getattr(T, x.kind)) for x in a.attachments)
    role, parts = C.read_turn(T, a.formatted, [x.asDict() for x in a.attachments])
    assert role == "user" and [p.get("text", p.get("ref")) for p in parts] == [
        "see <|image|> ", "a.png", "b.wav", " and ", "c.pdf", None, "d", "clip"]
    b = got[1]
    assert [T.unescape(b.formatted[s.start:s.end]) for s in b.loss] == ["ok</s>", "!"]
    assert got[2].formatted == got[3].formatted == f"{T.start}user{T.content}{T.end}"


def test_templates_that_could_not_be_read_back_are_refused():
    for bad in (dict(start="<|im"), dict(image="aba"), dict(end="x\u2060y"), dict(audio="]x[")):
        with pytest.raises(ValueError):
            C.Template(**bad)


def test_query(spark, tmp_path):
    from trailguard.llm.queries import HARD_TEXT, op11_chat_format
    rows = [(c, t, "assistant" if t else "user", f"text {c} {t}") for c in range(9) for t in range(2)]
    spark.createDataFrame(rows, SCHEMA).withColumn("role", F.col("role")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op11_chat_format(spark, str(tmp_path)).collect()}
    assert got == digests([*rows, (-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT)])
