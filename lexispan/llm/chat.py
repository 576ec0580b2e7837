"""Chat formatting: turn order by a state machine over roles, text segments with loss flags.

A ``Template`` declares everything: the strings that mark a turn, the roles whose text
is learnt, the order in which roles may follow each other and the control strings that
must not reach the output from inside a text.  Formatting is one aggregation per
conversation and array expressions on its row.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = ""
INVALID = "!"


@dataclass(frozen=True)
class Template:
    """``<turn>role<body>text<close>`` per turn.

    ``follows`` maps each state of the machine (``START`` or the role before) to the
    roles that may come next.  ``foreign`` lists control strings of other formats that
    are escaped as well.
    """

    turn: str = "<|turn|>"
    body: str = "<|text|>"
    close: str = "<|end|>"
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant", "tool"),
    })
    # Control strings of widespread chat formats.
    foreign: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>",
    )
    escape: str = "\\"

    def __post_init__(self) -> None:
        controls = self.controls
        for a in controls:
            if len(a) < 2 or self.escape in a:
                raise ValueError(f"{a!r} can't be escaped")
            if any(a[:k] == a[-k:] for k in range(1, len(a))):
                raise ValueError(f"{a!r} overlaps itself")
            if any(a != b and a in b for b in controls):
                raise ValueError(f"{a!r} is part of another control string")

    @property
    def controls(self) -> list[str]:
        return list(dict.fromkeys([self.turn, self.body, self.close, *self.foreign]))

    def hide(self, text: Column) -> Column:
        """Double the escape character and break every control string after its first character."""
        hidden = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        return functools.reduce(
            lambda c, s: F.replace(c, F.lit(s), F.lit(self._broken(s))), self.controls, hidden
        )

    def show(self, text: Column) -> Column:
        """The inverse of ``hide``.

        After ``hide`` a run of escape characters has odd length only where a control
        string was broken, so its broken form can't come from anywhere else.
        """
        shown = functools.reduce(
            lambda c, s: F.replace(c, F.lit(self._broken(s)), F.lit(s)),
            reversed(self.controls), text,
        )
        return F.replace(shown, F.lit(self.escape * 2), F.lit(self.escape))

    def _broken(self, control: str) -> str:
        return control[0] + self.escape + control[1:]


def _machine(template: Template, roles: Column) -> Column:
    """The state after all roles: the last role, or ``INVALID`` from the first wrong one on."""
    moves = F.array(*[
        F.struct(F.lit(state).alias("state"), F.lit(role).alias("role"))
        for state, following in template.follows.items() for role in following
    ])
    return F.aggregate(roles, F.lit(START), lambda state, role: F.when(
        F.array_contains(moves, F.struct(state.alias("state"), role.alias("role"))), role
    ).otherwise(F.lit(INVALID)))


def format_chats(
    rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``(conv_id, segments, formatted, state, valid)`` per conversation.

    ``segments`` is an array of ``(text, loss)``; their texts joined are ``formatted``.
    Turns go by ``turn``, nulls first, equal turns by role and text; null role and null
    text count as empty.  A wrong order is reported in ``valid`` and still formatted.
    Rows of a null conversation form one conversation.  No rows give no rows, and other
    columns are not read.  A conversation is one row of the result and so has to fit
    into one; however many conversations there are, each is gathered by itself.
    """
    turns = rows.groupBy(F.col(conv_id).alias("_conv")).agg(F.array_sort(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ))).alias("turns"))

    def pieces(t: Column) -> Column:
        trained = t["role"].isin(*template.trained)
        head = F.concat(F.lit(template.turn), template.hide(t["role"]), F.lit(template.body))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(template.hide(t["text"]).alias("text"), trained.alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    state = _machine(template, F.transform("turns", lambda t: t["role"]))
    return turns.select(
        F.col("_conv").alias(conv_id), F.flatten(F.transform("turns", pieces)).alias("segments"),
        state.alias("state"), (state != INVALID).alias("valid"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def turns_of(formatted: Column, template: Template = Template()) -> Column:
    """``array<(role, text)>`` read back from a formatted conversation."""
    parts = F.split(formatted, re.escape(template.turn))

    def turn(part: Column) -> Column:
        fields = F.split(part, re.escape(template.body))
        text = F.substring_index(F.get(fields, 1), template.close, 1)
        return F.struct(
            template.show(F.get(fields, 0)).alias("role"), template.show(text).alias("text")
        )

    return F.transform(F.slice(parts, 2, F.size(parts)), turn)


def learnt_text(segments: Column, template: Template = Template()) -> Column:
    """The text under the loss mask, unescaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: template.show(s["text"])), "")
