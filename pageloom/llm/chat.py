"""Operator 1: chat formatting.

A declarative template names the roles, the turns that may follow one
another and the strings around a turn; a finite-state machine over a
conversation's roles validates the order, and every turn becomes segments of
text with a loss flag.  All of it is DataFrame functions.

Inside a text or role the control strings are escaped: a ``<`` that is
followed by backslashes and a ``|`` gets one backslash more, so ``<|`` never
appears outside the template's own marks and :func:`read_back` is exact.  A
role is percent-escaped for line feeds too, as it ends at the line's end.

Cases: a null text is an empty one; a null role is an empty one, which no
state accepts; rows with a null turn come first; equal turns are ordered by
role and text, repeated rows stay repeated turns; a null conversation id is
a conversation of its own; an empty table gives an empty table.  A
conversation whose order is wrong is formatted like any other, with
``valid`` false and ``first_wrong`` the index of the first turn that no rule
allows.  Only the four named columns are read.  A conversation is one row of
the result, as a training sequence is, so its turns meet in one group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``follows``: state -> the roles that may come next; a role's name is
    the state after it, ``start`` the state before the first.  ``open`` and
    ``close`` begin and end a turn; ``learned`` roles bear loss."""
    open: str = "<|im_start|>"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "^"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "^": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col, segments`` (array of ``text``
    and ``loss``, whose texts joined are ``formatted``), ``formatted``,
    ``valid``, ``first_wrong`` (null if valid)."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    rules = F.create_map(*[x for state, roles in template.follows.items()
                           for x in (F.lit(state), F.array(*[F.lit(r) for r in roles]))])

    def step(acc: Column, t: Column) -> Column:
        allowed = F.coalesce(F.array_contains(F.try_element_at(rules, acc["state"]), t["role"]), F.lit(False))
        return F.struct(t["role"].alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(acc["wrong"].isNull() & ~allowed, acc["at"]).otherwise(acc["wrong"]).alias("wrong"))

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("wrong"))
    learned = F.array(*[F.lit(r) for r in template.learned])

    def segments(t: Column) -> Column:
        def part(text, loss):
            return F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(F.concat(F.lit(template.open), _escape_role(t["role"]), F.lit("\n")), F.lit(False)),
                       part(escape(t["text"]), F.array_contains(learned, t["role"])),
                       part(F.lit(template.close), F.lit(False)))

    return chats.select(
        F.col("conv").alias(conv_col), F.flatten(F.transform("turns", segments)).alias("segments"),
        F.aggregate("turns", begin, step, lambda a: a["wrong"]).alias("first_wrong")).select(
        conv_col, "segments", F.array_join("segments.text", "").alias("formatted"),
        F.col("first_wrong").isNull().alias("valid"), "first_wrong")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``formatted`` plus ``turns`` (array of ``role`` and ``text``, read from
    the formatted string) and ``loss_text`` (all text under the loss mask,
    each segment unescaped by itself: an escape never runs over its end)."""
    pieces = F.filter(F.split("formatted", _literal(template.open), -1), lambda _, i: i > 0)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.length(piece) - len(template.close))
        return F.struct(_unescape_role(F.substring_index(body, "\n", 1)).alias("role"),
                        unescape(F.substring(body, F.position(F.lit("\n"), body) + 1, F.length(body))).alias("text"))

    learned = F.filter("segments", lambda s: s["loss"])["text"]
    return formatted.select("*", F.transform(pieces, turn).alias("turns"),
                            F.array_join(F.transform(learned, unescape), "").alias("loss_text"))


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def digests(read: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Turn count and digests of :func:`read_back`'s rows."""
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(conv_col, F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")
