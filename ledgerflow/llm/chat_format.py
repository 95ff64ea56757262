"""Chat formatting: a finite-state machine over roles, a declarative template, reversible marks.

A template names its states, the transitions that a role makes between them, and
for each role the strings that open and close a turn and whether its text counts
for the loss. Turns of a conversation are folded through the machine: the first
turn without a transition is ``bad_turn``, a conversation that stops in a state
that is not accepting has ``bad_turn = n_turns``, and one without either is
``valid``. Every conversation is formatted, valid or not, so a caller decides what
to drop. The output is a list of segments with a loss flag each; their texts
joined are the formatted conversation.

Control strings never occur bare inside a text: a guard character goes behind the
first character of each (and one more behind those that already look guarded), and
taking one away gives the text back. ``ChatTemplate`` refuses control strings that
overlap or hold each other, the guard or white space, so what is a mark and what is
text can always be told apart; ``read_turns`` does that from the joined text alone.

Everything is DataFrame functions: escaping happens row by row before the one
shuffle, which brings a conversation together; it becomes one row, as its output
is one.

Defined cases: a null text or role is empty; roles the template does not name are
written with their name in the marks, carry no loss and have no transition. Turns
come in order of (turn, role, text), nulls first, so repeated rows and ties are
kept and stable. A row without a conversation id is a conversation of its own. An
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How a role is written: ``open`` begins and ``close`` ends with or is a control string."""
    role: str
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    turns: tuple[Turn, ...]
    transitions: tuple[tuple[str, str, str], ...]  # state, role, next state
    start: str
    accepting: tuple[str, ...]
    begin: str = ""
    controls: tuple[str, ...] = ()
    other_open: str = "[ROLE]"
    other_named: str = "[/ROLE] "
    other_close: str = " [/TURN]"
    guard: str = "\\"

    def __post_init__(self):
        marks = [x for t in self.turns for x in (t.open, t.close)] + [self.other_open, self.other_named, self.other_close, self.begin]
        for x in self.controls:
            if len(x) < 2 or self.guard in x or re.search(r"\s", x):
                raise ValueError(f"control string {x!r} is too short or holds the guard or white space")
        for a, b in itertools.product(self.controls, repeat=2):
            if a != b and a in b or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                raise ValueError(f"control strings {a!r} and {b!r} overlap")
        for x in filter(None, marks):
            if x.strip() not in self.controls:
                raise ValueError(f"mark {x!r} is not one control string with white space")
        if "" in {x for s, _, n in self.transitions for x in (s, n)} | {self.start}:
            raise ValueError("a state needs a name")
        opens = [t.open.strip() for t in self.turns] + [self.other_open.strip()]
        if len(set(opens)) < len(opens) or len({t.role for t in self.turns}) < len(self.turns):
            raise ValueError("each role needs a mark of its own to open with")
        if any(t.open != t.open.lstrip() or t.close != t.close.rstrip() for t in self.turns):
            raise ValueError("a turn begins and ends with its control string")


#: Instructions and answers in turns, after at most one system turn.
INSTRUCT = ChatTemplate(
    turns=(Turn("system", "<<SYS>>\n", "\n<</SYS>>"), Turn("user", "[INST] ", " [/INST]"), Turn("assistant", "[ANSWER] ", " </s>", loss=True)),
    transitions=(("start", "system", "told"), ("start", "user", "asked"), ("told", "user", "asked"),
                 ("asked", "assistant", "answered"), ("answered", "user", "asked")),
    start="start", accepting=("answered",), begin="<s>",
    controls=("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANSWER]", "[ROLE]", "[/ROLE]", "[/TURN]"))


def _tails(template: ChatTemplate) -> dict[str, str]:
    """For each first character of a control string, a pattern of what may follow it."""
    by_first: dict[str, list[str]] = {}
    for x in template.controls:
        by_first.setdefault(x[0], []).append(re.escape(x[1:]))
    return {first: "(?:" + "|".join(rest) + ")" for first, rest in by_first.items()}


def escape(text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """``text`` without bare control strings."""
    guard = re.escape(template.guard)
    found = "|".join(f"{re.escape(first)}(?={guard}*{rest})" for first, rest in _tails(template).items())
    return F.regexp_replace(text, found, "$0" + guard if template.guard in "\\$" else "$0" + template.guard)


def unescape(text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """What ``escape`` was given."""
    guard = re.escape(template.guard)
    found = "|".join(f"(?<={re.escape(first)}){guard}(?={guard}*{rest})" for first, rest in _tails(template).items())
    return F.regexp_replace(text, found, "")


def _by_role(template: ChatTemplate, role: Column, value, other: Column) -> Column:
    """``value(turn)`` of the turn that the template has for ``role``."""
    out = None
    for t in template.turns:
        out = (F if out is None else out).when(role == t.role, value(t))
    return other if out is None else out.otherwise(other)


def _fold(template: ChatTemplate, turns: Column) -> Column:
    """The machine's run over the turns: ``state`` (empty once a turn had no transition), ``at``,
    ``bad`` (-1 or the first such turn). No field is ever null, as the type of a fold is that of its start."""
    def step(run, turn):
        reached = F.lit("")
        for state, role, after in template.transitions:
            reached = F.when((run["state"] == state) & (turn["role"] == role), F.lit(after)).otherwise(reached)
        bad = F.when((run["bad"] < 0) & (reached == ""), run["at"]).otherwise(run["bad"])
        return F.struct(reached.alias("state"), (run["at"] + 1).alias("at"), bad.alias("bad"))

    first = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))
    return F.aggregate(turns, first, step)


def format_conversations(rows: DataFrame, template: ChatTemplate = INSTRUCT, id_column: str = "conv_id", turn_column: str = "turn",
                         role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``id, n_turns, text, segments (array of text, loss), valid, bad_turn`` of each conversation."""
    role = F.coalesce(F.col(role_column), F.lit(""))
    said = escape(F.coalesce(F.col(text_column), F.lit("")), template)
    flat = rows.select(
        F.col(id_column).alias("conv"), F.when(F.col(id_column).isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.struct(F.col(turn_column).alias("turn"), role.alias("role"), said.alias("said")).alias("row"))
    runs = flat.groupBy("conv", "alone").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    runs = runs.select("conv", "rows", _fold(template, F.col("rows")).alias("run"))

    def emit(row):
        named = F.concat(F.lit(template.other_open), escape(row["role"], template), F.lit(template.other_named))
        opened = _by_role(template, row["role"], lambda t: F.lit(t.open), named)
        closed = _by_role(template, row["role"], lambda t: F.lit(t.close), F.lit(template.other_close))
        loss = _by_role(template, row["role"], lambda t: F.lit(t.loss), F.lit(False))
        mark = lambda x: F.struct(x.alias("text"), F.lit(False).alias("loss"))
        return F.array(mark(opened), F.struct(row["said"].alias("text"), loss.alias("loss")), mark(closed))

    segments = F.flatten(F.transform("rows", emit))
    if template.begin:
        segments = F.concat(F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss"))), segments)
    stopped = F.when(~F.col("run")["state"].isin(*template.accepting), F.col("run")["at"])
    runs = runs.select("conv", segments.alias("segments"), F.size("rows").cast("long").alias("n_turns"),
                       F.coalesce(F.nullif(F.col("run")["bad"], F.lit(-1)), stopped).cast("long").alias("bad_turn"))
    return runs.select(F.col("conv").alias(id_column), "n_turns", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"),
                       "segments", F.col("bad_turn").isNull().alias("valid"), "bad_turn")


def read_turns(text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """The turns (array of role, text) that a formatted conversation was made of."""
    other = (template.other_open, template.other_named, template.other_close)
    forms = [re.escape(t.open) + ".*?" + re.escape(t.close) for t in template.turns] + [".*?".join(map(re.escape, other))]
    units = F.regexp_extract_all(text, F.lit("(?s)(?:" + "|".join(forms) + ")"), F.lit(0))

    def inside(unit, opened: Column, closed: str) -> Column:
        return F.substring(unit, F.length(opened) + 1, F.length(unit) - F.length(opened) - len(closed))

    def turn(unit):
        name = F.substring_index(F.substring(unit, len(other[0]) + 1, F.length(unit)), other[1], 1)
        role, said = unescape(name, template), inside(unit, F.concat(F.lit(other[0]), name, F.lit(other[1])), other[2])
        for t in template.turns:
            mine = F.startswith(unit, F.lit(t.open))
            role = F.when(mine, F.lit(t.role)).otherwise(role)
            said = F.when(mine, inside(unit, F.lit(t.open), t.close)).otherwise(said)
        return F.struct(role.alias("role"), unescape(said, template).alias("text"))

    return F.transform(units, turn)


def loss_text(segments: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")


def digests(formatted: DataFrame, template: ChatTemplate = INSTRUCT, id_column: str = "conv_id") -> DataFrame:
    """What formatted conversations hold, read back from them."""
    read = formatted.select(id_column, "text", "valid", "bad_turn", read_turns(F.col("text"), template).alias("turns"),
                            loss_text(F.col("segments"), template).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(id_column, F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                       F.length("text").cast("long").alias("formatted_chars"), "valid", "bad_turn")
