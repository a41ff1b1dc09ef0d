"""Rules for one chat message.

A message is anything that gives a column per field name: a struct column
inside ``transform``, or a dict of plain columns of a turn table. Rules return
the fields they change, so arrays and turn tables share them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T

from ..options import PrepOptions
from .text import as_string, is_blank, lstrip, strip, to_text
from .tokens import IM_END, IM_START, THINK_CLOSE, THINK_OPEN, cap_tokens

# Roles the chat template understands.
KNOWN_ROLES = ("system", "user", "assistant", "tool")

Message = Column | Mapping[str, Column]
Fields = dict[str, Column]

MESSAGE_TYPE = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("reasoning_content", T.StringType()),
        T.StructField("tool_calls", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("moved", T.IntegerType()),
        T.StructField("extracted", T.IntegerType()),
    ]
)


def from_source(m: Message, source: T.StructType, pos: Column, opts: PrepOptions) -> Fields:
    """Canonical fields: trimmed role, text content, settled reasoning.

    A blank reasoning field takes the first non-blank alternative (trimmed),
    whatever the role; ``moved`` counts that.
    """
    types = {f.name: f.dataType for f in source}

    def text(name: str) -> Column:
        return as_string(m[name], types[name]) if name in types else F.lit(None).cast("string")

    target = text(opts.reasoning_target)
    others = [F.nullif(strip(text(k)), F.lit("")) for k in opts.reasoning_sources if k in types]
    fallback = F.coalesce(*others) if others else F.lit(None).cast("string")
    moves = is_blank(target) & fallback.isNotNull()
    return {
        "pos": pos.cast("long"),
        "role": strip(to_text(text("role"))),
        "content": to_text(text("content")),
        "reasoning_content": F.when(moves, fallback).otherwise(target),
        "tool_calls": text("tool_calls"),
        "name": text("name"),
        "moved": moves.cast("int"),
        "extracted": F.lit(0),
    }


def as_struct(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def with_fields(m: Column, fields: Fields) -> Column:
    """Message struct with some fields replaced or added."""
    for name, value in fields.items():
        m = m.withField(name, value)
    return m


def plain_message(role: str, content: Column) -> Column:
    """Source-shaped message struct of a role and its text."""
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def is_blank_system(m: Message) -> Column:
    """System messages without content are dropped wherever they stand."""
    return (m["role"] == "system") & is_blank(m["content"])


def think_block(m: Message) -> Fields:
    """``open`` and ``close``: where the first closed think block starts and ends (0: none)."""
    start = F.locate(THINK_OPEN, m["content"])
    end = F.position(F.lit(THINK_CLOSE), m["content"], start + len(THINK_OPEN))
    found = (m["role"] == "assistant") & (start > 0) & (end > 0)
    return {
        "open": F.when(found, start).otherwise(0),
        "close": F.when(found, end).otherwise(0),
    }


def cut_think_block(m: Message) -> Fields:
    """Move the located block out of the content.

    Its text fills the reasoning field only if that is blank; the block is cut
    and counted either way.
    """
    content, reasoning, found = m["content"], m["reasoning_content"], m["close"] > 0
    inner_at = m["open"] + len(THINK_OPEN)
    inner = strip(F.substr(content, inner_at, m["close"] - inner_at))
    before = F.substr(content, F.lit(1), m["open"] - 1)
    after = lstrip(F.substr(content, m["close"] + len(THINK_CLOSE)))
    return {
        "content": F.when(found, lstrip(F.concat(before, after))).otherwise(content),
        "reasoning_content": F.when(found & is_blank(reasoning), inner).otherwise(reasoning),
        "extracted": found.cast("int"),
    }


def is_dropped_think(m: Message, opts: PrepOptions) -> Column:
    """Think-role messages go away in drop mode."""
    return (m["role"] == opts.think_role) if opts.drops_thinking else F.lit(False)


def think_policy(m: Message, opts: PrepOptions) -> Fields:
    """Clear present reasoning in drop mode, cap it (and think turns) otherwise."""
    content, reasoning = m["content"], m["reasoning_content"]
    if opts.drops_thinking:
        return {"reasoning_content": F.when(reasoning.isNotNull(), F.lit(""))}
    if not opts.token_cap:
        return {}
    is_think = m["role"] == opts.think_role
    return {
        "content": F.when(is_think, cap_tokens(content, opts.token_cap)).otherwise(content),
        "reasoning_content": cap_tokens(reasoning, opts.token_cap),
    }


def is_unknown_role(role: Column, opts: PrepOptions) -> Column:
    return (role != "") & ~role.isin(*KNOWN_ROLES, opts.think_role)


def has_reasoning(m: Message) -> Column:
    """Assistant message whose reasoning can be shortened."""
    return (m["role"] == "assistant") & ~is_blank(m["reasoning_content"])


def opening(m: Message) -> Column:
    return F.concat(F.lit(IM_START), m["role"], F.lit("\n"))


def think_text(reasoning: str) -> str:
    """Think block as it is rendered."""
    return f"{THINK_OPEN}\n{reasoning}\n{THINK_CLOSE}\n\n"


def answer(m: Message) -> Column:
    """What follows the think block, up to the end marker."""
    calls = F.concat(F.lit("\n<tool_call>\n"), m["tool_calls"], F.lit("\n</tool_call>"))
    return F.concat(m["content"], F.coalesce(calls, F.lit("")))


def _body(m: Message, reasoning: Column) -> Column:
    shows = (m["role"] == "assistant") & (F.coalesce(reasoning, F.lit("")) != "")
    before, after = think_text("|").split("|")
    thought = F.concat(F.lit(before), reasoning, F.lit(after))
    return F.concat(F.when(shows, thought).otherwise(""), answer(m))


def render(m: Message, reasoning: Column | None = None) -> Column:
    """ChatML text of one message; ``reasoning`` replaces the message's own."""
    shown = m["reasoning_content"] if reasoning is None else reasoning
    return F.concat(opening(m), _body(m, shown), F.lit(IM_END + "\n"))


def tools_text(tools: Column) -> Column:
    return F.concat(F.lit("# Tools\n<tools>\n"), tools, F.lit("\n</tools>"))


def tools_block(tools: Column) -> Column:
    """Tool schemas as a system block of their own."""
    return F.concat(F.lit(IM_START + "system\n"), tools_text(tools), F.lit(IM_END + "\n"))


def render_first(m: Message, tools: Column, reasoning: Column | None = None) -> Column:
    """Like :func:`render` for the first message, with tool schemas.

    They close an opening system message, or stand in a system block of their
    own before any other first message.
    """
    shown = m["reasoning_content"] if reasoning is None else reasoning
    in_system = F.concat(
        opening(m),
        _body(m, shown),
        F.lit("\n\n"),
        tools_text(tools),
        F.lit(IM_END + "\n"),
    )
    return (
        F.when(tools.isNull(), render(m, shown))
        .when(m["role"] == "system", in_system)
        .otherwise(F.concat(tools_block(tools), render(m, shown)))
    )
