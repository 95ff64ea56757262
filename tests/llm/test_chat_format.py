"""Chat formatting: round trips, the machine, the loss mask."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import chat_format
from ledgerflow.llm.chat_format import INSTRUCT, ChatTemplate, Turn

from .conftest import CLASHING

SCHEMA = "conv_id long, turn long, role string, text string"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING + ["rows", "run", "segments", "valid", "conv"]})


def machine(roles):
    after = {(s, r): n for s, r, n in INSTRUCT.transitions}
    state = INSTRUCT.start
    for i, r in enumerate(roles):
        state = after.get((state, r))
        if state is None:
            return i
    return None if state in INSTRUCT.accepting else len(roles)


def check(spark, rows):
    """Everything read back equals the rows, and the digests follow."""
    formatted = chat_format.format_conversations(make(spark, rows))
    for plan in (formatted, chat_format.digests(formatted)):
        shown = plan._jdf.queryExecution().toString()
        assert "Python" not in shown and "Arrow" not in shown
    convs = {}
    low = lambda x: (x is not None, x if x is not None else 0)
    for at, r in enumerate(rows):
        convs.setdefault(("alone", at) if r[0] is None else r[0], []).append((low(r[1]), r[2] or "", r[3] or "", r[1]))
    want = []
    for key, turns in convs.items():
        turns = [(role, text) for _, role, text, _ in sorted(turns, key=lambda t: (t[0], t[1], t[2]))]
        learned = "".join(text for role, text in turns if role == "assistant")
        want.append((None if isinstance(key, tuple) else key, tuple(turns), learned, machine([r for r, _ in turns])))
    read = formatted.select("conv_id", chat_format.read_turns(F.col("text")).alias("turns"), chat_format.loss_text(F.col("segments")).alias("learned"),
                            "text", "segments", "n_turns", "valid", "bad_turn").collect()
    key = lambda x: (str(x[0]), x[1:3])
    got = [(r.conv_id, tuple((t.role, t.text) for t in r.turns), r.learned, r.bad_turn) for r in read]
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in read:
        assert r.text == "".join(s.text for s in r.segments) and r.n_turns == len(r.turns) and r.valid == (r.bad_turn is None)
        assert sum(r.text.count(c) for c in ("[INST]", "[/INST]", "[ANSWER]", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/TURN]", "[/ROLE]")) == sum(
            3 if t.role not in ("system", "user", "assistant") else 2 for t in r.turns)
    digests = {}
    for r in chat_format.digests(formatted).collect():
        digests.setdefault((r.conv_id, r.turns_sha256), []).append((r.n_turns, r.loss_chars, r.loss_sha256))
    for conv, turns, learned, _ in want:
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (len(turns), len(learned), hashlib.sha256(learned.encode()).hexdigest()) in digests[conv, hashlib.sha256(told.encode()).hexdigest()]
    assert len(read) == sum(map(len, digests.values()))


def test_random_texts_of_marks(spark):
    r = random.Random(11)
    parts = [*INSTRUCT.controls, "\\", "\\\\", "<", "[", "<\\", "[\\", "s>", "/s>", "<SYS>>", "INST]", "/INST]", "/TURN]", " ", "\n", "é😀", "a", "$0", "]"]
    text = lambda: "".join(r.choice(parts) for _ in range(r.randrange(8)))
    rows = [(i, t, r.choice(["user", "assistant", "system", "user", "assistant", "tool", text()]), text()) for i in range(700) for t in range(r.randrange(1, 6))]
    check(spark, rows)


def test_edges(spark):
    check(spark, [
        (1, 0, "user", "a"), (1, 1, "assistant", None), (1, 2, None, "x"),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, None, "system", "first"),
        (None, 0, "user", "alone"), (None, 1, "assistant", "alone too"), (None, None, None, None),
        (3, 5, "assistant", ""), (4, 0, "User", " "), (4, 1, "", "\\"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
        (5, 0, "user", "aé <s> [INST]\\" * 100_000), (5, 1, "assistant", " [/INST] <\\/s>\n" * 100_000)])
    empty = chat_format.digests(chat_format.format_conversations(make(spark, []).limit(0)))
    assert empty.count() == 0
    many = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(5000)]
    check(spark, many)


def test_the_machine(spark):
    said = lambda conv, roles: [(conv, i, r, "t") for i, r in enumerate(roles)]
    cases = {1: ["user", "assistant"], 2: ["system", "user", "assistant"], 3: ["assistant"], 4: ["user", "user", "assistant"], 5: ["user"],
             6: ["user", "assistant", "system", "user", "assistant"], 7: ["system"], 8: ["user", "tool", "assistant"], 9: ["user", "assistant"] * 4}
    rows = [x for conv, roles in cases.items() for x in said(conv, roles)]
    got = {r.conv_id: r.bad_turn for r in chat_format.format_conversations(make(spark, rows)).collect()}
    assert got == {1: None, 2: None, 3: 0, 4: 1, 5: 1, 6: 2, 7: 1, 8: 1, 9: None}


def test_another_template(spark):
    """Another set of marks, a guard that means something to patterns, loss on two roles."""
    t = ChatTemplate(turns=(Turn("q", "<q>", "</q>", loss=True), Turn("a", "<a> ", "</a>", loss=True)), transitions=(("0", "q", "1"), ("1", "a", "0")),
                     start="0", accepting=("0",), controls=("<q>", "</q>", "<a>", "</a>", "<o>", "<n>", "<e>"), other_open="<o>", other_named="<n>", other_close="<e>", guard="$")
    rows = [(1, 0, "q", "<q>$</a><$a> $1 \\"), (1, 1, "a", "<$$q></q>"), (1, 2, "x<n>", "<e><$e>")]
    row = chat_format.format_conversations(make(spark, rows), t).select(
        chat_format.read_turns(F.col("text"), t).alias("turns"), chat_format.loss_text(F.col("segments"), t).alias("loss"), "bad_turn").collect()[0]
    assert [(x.role, x.text) for x in row.turns] == [(r[2], r[3]) for r in rows]
    assert row.loss == rows[0][3] + rows[1][3] and row.bad_turn == 2


@pytest.mark.parametrize("controls", [("<a>", "<a>b"), ("ab", "bc"), ("aba", "x["), ("a b", "cd"), ("a\\b", "cd"), ("x", "yz")])
def test_ambiguous_control_strings_are_refused(controls):
    with pytest.raises(ValueError):
        ChatTemplate(turns=(Turn("u", controls[0], controls[1]),), transitions=(), start="s", accepting=("s",), controls=controls)
