"""Prefix-target expansion: round trip, mask, odd rows."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\n", "a\nb", "<s>[INST]user\nx[/INST]</s>", "", "[", "<", "[/INST]", "\\</s>", None]


def brute(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
    whole = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in turns)
    loss = "".join(x or "" for _, r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def digests(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    got = chat.conversation_digests(chat.format_conversations(df)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}


def test_nasty_texts_roles_nulls_ties_and_clashing_columns(spark):
    rows = [(c, t % 4 if c else None, ["user", "assistant", "sys\ntem", None, "</s>"][(t + c) % 5], x, "x", 7)
            for c in (0, 1, 2, None) if c is not None for t, x in enumerate(NASTY)]
    rows += [(None, None, "assistant", "no id", "x", 1), (9, 1, "user", "only a question", "x", 1), (9, 1, "user", "only a question", "x", 1)]
    want = {c: brute([(t, r, x) for k, t, r, x, *_ in rows if k == c]) for c in {r[0] for r in rows}}
    assert digests(spark, rows) == want


def test_each_reply_is_one_example_and_the_tail_has_no_target(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df).orderBy("example_no").collect()
    assert [r.formatted[r.loss_start:r.loss_end] if r.loss_start is not None else None for r in got] == ["a1", "a2", None]
    assert got[1].formatted.startswith(got[0].formatted) and [r.is_last for r in got] == [False, False, True]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(df)).count() == 0


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet="<>/s[]INST\\\n é", max_size=12), min_size=1, max_size=6))
def test_any_text_round_trips(spark, texts):
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x", 0) for i, t in enumerate(texts)]
    assert digests(spark, rows) == {1: brute([(i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)])}


def test_no_python_in_the_plan(spark):
    import contextlib
    import io
    with contextlib.redirect_stdout(io.StringIO()) as out:
        chat.op8_prefix_target(spark, "/root/testdata/sf0.001").explain()
    assert not any(w in out.getvalue() for w in ("Python", "Pandas", "Arrow"))
