"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame
operations only.

A template gives each role the marks around its text and whether the text is learned.  A
conversation becomes segments (text, loss); their texts in a row are the formatted conversation.
Inside texts a backslash is doubled, and one is put behind the first character of every control
string, so that no control string of the template is left and `unescape` gives the text back.

The state machine follows the roles turn by turn; a conversation is valid if it ends in a state
where it may.  Conversations that aren't are formatted all the same and marked.

Defined cases: a null text or role is empty.  A role that the template doesn't name is written
between role marks, escaped.  Turns are ordered by turn, role, text; repeated rows stay.  Rows
without conv_id are one conversation without id.  Other columns are ignored.  One conversation is
one value of the result and so is built in one row; it must fit into a value.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn]
    other_open: str  # before the name of a role that `turns` lacks
    other_name: str  # between name and text
    other_close: str
    control: tuple[str, ...]  # strings that must not stand in a text
    moves: dict[tuple[str, str], str]  # state and role to the next state; any other move is an error
    start: str
    ends: tuple[str, ...]


TEMPLATE = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s>", "</s>\n", loss=True),
    },
    other_open="[ROLE]", other_name="[/ROLE]", other_close="[/TURN]\n",
    control=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]"),
    moves={
        ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    },
    start="start", ends=("answered",),
)


def _quote(text: str) -> str:
    """text as a pattern, readable by Java."""
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text).replace("\\\n", "\\n")


def escape(text: Column, template: Template) -> Column:
    heads = "|".join(f"{_quote(c[0])}(?={_quote(c[1:])})" for c in template.control)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({heads})", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segments(turn: Column, template: Template) -> Column:
    """The three or five segments of a turn: marks, name, text."""
    piece = lambda text, loss=False: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    text = escape(turn["text"], template)
    out = F.array(
        piece(F.lit(template.other_open)), piece(escape(turn["role"], template)), piece(F.lit(template.other_name)),
        piece(text), piece(F.lit(template.other_close)),
    )
    for role, t in template.turns.items():
        known = F.array(piece(F.lit(t.open)), piece(text, t.loss), piece(F.lit(t.close)))
        out = F.when(turn["role"] == role, known).otherwise(out)
    return out


def _final_state(turns: Column, template: Template) -> Column:
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    step = lambda state, turn: F.coalesce(moves[F.concat(state, F.lit("\n"), turn["role"])], F.lit("error"))
    return F.aggregate(turns, F.lit(template.start), step)


def format_chats(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, segments (text, loss), formatted, valid and state, the machine's last one."""
    row = F.struct(F.col("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    state = _final_state(F.col("turns"), template)
    chats = chats.select(
        "conv_id", state.alias("state"),
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
    )
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select("conv_id", "segments", formatted.alias("formatted"), F.col("state").isin(*template.ends).alias("valid"), "state")


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    opens = [_quote(t.open) for t in template.turns.values()]
    closes = [_quote(t.close) for t in template.turns.values()]
    named = f"{_quote(template.other_open)}(.*?){_quote(template.other_name)}"
    pattern = F.lit(f"(?s)({'|'.join(opens)}|{named})(.*?)(?:{'|'.join(closes)}|{_quote(template.other_close)})")
    part = lambda group: F.regexp_extract_all(formatted, pattern, F.lit(group))
    role = lambda mark, name: F.coalesce(
        F.create_map(*[F.lit(x) for r, t in template.turns.items() for x in (t.open, r)])[mark], unescape(name)
    )
    marks = F.arrays_zip(part(1).alias("mark"), part(2).alias("name"), part(3).alias("text"))
    return F.transform(marks, lambda m: F.struct(role(m["mark"], m["name"]).alias("role"), unescape(m["text"]).alias("text")))


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
