"""Chat conversations as training text with a loss flag per segment."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import let


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are marked, which roles are learned, and which turn may follow which.

    ``guard`` stands in every control string, but not first; inside texts and roles it
    and the escape sign are prefixed with the escape sign, so no text holds a control
    string.
    ``turns`` lists (state, role, next state); a conversation may end in ``ends``.
    """

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    guard: str = "|"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    turns: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"),
        ("start", "user", "asked"),
        ("ready", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    )
    ends: tuple[str, ...] = ("answered",)

    def __post_init__(self) -> None:
        if min(self.open.find(self.guard), self.close.find(self.guard)) < 1:
            raise ValueError("the guard must stand inside both control strings")


def escaped(template: ChatTemplate, text: Column) -> Column:
    sign = template.escape
    doubled = F.replace(text, F.lit(sign), F.lit(sign * 2))
    return F.replace(doubled, F.lit(template.guard), F.lit(sign + template.guard))


def unescaped(template: ChatTemplate, text: Column) -> Column:
    either = f"([{re.escape(template.escape)}{re.escape(template.guard)}])"
    return F.regexp_replace(text, re.escape(template.escape) + either, "$1")


def _role_escaped(template: ChatTemplate, role: Column) -> Column:
    """As a text, and without the string that ends the role."""
    ending = F.lit(template.after_role)
    return F.replace(escaped(template, role), ending, F.lit(template.escape + "n"))


def _role_unescaped(template: ChatTemplate, role: Column) -> Column:
    sign = re.escape(template.escape)
    stand_in = f"(?<!{sign})((?:{sign}{sign})*+){sign}n"
    ending = re.sub(r"([\\$])", r"\\\1", template.after_role)
    return unescaped(template, F.regexp_replace(role, stand_in, f"$1{ending}"))


def format_chats(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: ``segments``, ``formatted``, ``valid``, ``bad_turn``.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored.
    ``segments`` is an array of (text, loss): header, body and end of every turn; only
    the bodies of learned roles carry loss. ``formatted`` is their concatenation.
    A finite-state machine over the roles, folded from the template's table, sets
    ``valid`` and ``bad_turn`` (position from 0 of the first turn out of order, NULL
    if none). Invalid conversations are formatted and flagged, not dropped.

    Turns are ordered by ``turn``, then role, then text, NULL first; repeated rows are
    turns of their own. A NULL text or role is empty; rows without ``conv_id`` are one
    conversation. No rows give no rows. One conversation is one row by definition, so
    its turns meet in one task; nothing else is grouped.
    """
    template = template or ChatTemplate()
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    step = F.create_map(
        *(F.lit(x) for state, role, after in template.turns for x in (f"{state} {role}", after))
    )

    def segments_of(turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit(""))
        head = F.concat(
            F.lit(template.open), _role_escaped(template, role), F.lit(template.after_role)
        )
        body = escaped(template, F.coalesce(turn["text"], F.lit("")))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(body.alias("text"), role.isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    def follow(at: Column, turn: Column) -> Column:
        after = F.get(
            F.array(step[F.concat(at["state"], F.lit(" "), F.coalesce(turn["role"], F.lit("")))]),
            F.lit(0),
        )
        stuck = at["bad"].isNotNull()
        return F.struct(
            F.when(stuck, at["state"]).otherwise(F.coalesce(after, at["state"])).alias("state"),
            F.when(stuck, at["bad"]).when(after.isNull(), at["seen"]).alias("bad"),
            (at["seen"] + 1).alias("seen"),
        )

    first = F.struct(
        F.lit("start").alias("state"),
        F.lit(None).cast("int").alias("bad"),
        F.lit(0).alias("seen"),
    )
    walked = collected.select(
        "conv_id",
        F.flatten(F.transform("turns", segments_of)).alias("segments"),
        F.aggregate("turns", first, follow).alias("walk"),
    )
    return walked.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("walk.bad").isNull() & F.col("walk.state").isin(*template.ends)).alias("valid"),
        F.col("walk.bad").alias("bad_turn"),
    )


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Turns (role, text) parsed back from formatted text."""
    template = template or ChatTemplate()
    pieces = F.split(formatted, re.escape(template.close))

    def turn_of(piece: Column) -> Column:
        def parsed(body: Column) -> Column:
            ends = F.locate(template.after_role, body).cast("int")
            role = F.substring(body, F.lit(1), ends - 1)
            text = F.substring(body, ends + len(template.after_role), F.length(body))
            return F.struct(
                _role_unescaped(template, role).alias("role"),
                unescaped(template, text).alias("text"),
            )

        return let(F.substring(piece, F.lit(len(template.open) + 1), F.length(piece)), parsed)

    return let(pieces, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), turn_of))


def read_loss(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, in order."""
    template = template or ChatTemplate()
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(template, s["text"])), "")
