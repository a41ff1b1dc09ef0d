"""Fit conversations into a token budget by whole messages.

Counts are taken once per message; which messages stay then follows from sums
of integers. All steps are narrow projections over message arrays that carry
their tokens (see :func:`turnloom.operators.rendering.tokenize_messages`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import message as msg
from ..functions.barrier import with_computed
from ..functions.tokens import token_count, tokens
from ..options import PrepOptions

# What was left out before assembly: tokens, those after the last assistant, and middle turns.
SKIPPED_TOTAL = "skipped_total"
SKIPPED_TAIL = "skipped_tail"
SKIPPED_MIDDLE = "skipped_middle"


def _count(m: Column) -> Column:
    return F.size(m["tokens"])


def total(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda a, m: a + _count(m))


def _lead(m: Column) -> Column:
    """Tokens of the tool schemas if ``m`` comes first; none where there is no message."""
    return F.when(m.isNull(), 0).otherwise(F.coalesce(m["lead"], F.col("tools_tokens")))


def _skipped(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) if name in df.columns else F.lit(0)


def truncation_anchors(df: DataFrame) -> DataFrame:
    """Add ``head`` (0 or 1 messages) and the 0-based ``last_assistant`` and ``tail_start``.

    The head is a leading system message. The tail runs from the message before
    the last assistant to the end. Without an assistant both positions are NULL.
    """
    first = F.get("messages", F.lit(0))
    assistants = F.filter(
        F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", i)),
        lambda i: i.isNotNull(),
    )
    df = df.withColumns(
        {
            "head": F.coalesce((first["role"] == "system").cast("int"), F.lit(0)),
            "last_assistant": F.array_max(assistants),
        }
    )
    last = F.col("last_assistant")
    return df.withColumn("tail_start", F.when(last.isNotNull(), F.greatest("head", last - 1)))


def _kept_middle(middle: Column, head_lead: Column, budget: Column) -> Column:
    """Size of the longest run at the end of ``middle`` that fits the budget.

    ``head_lead`` is what tool schemas cost in the head; NULL if there is no
    head, so that the first kept message carries them.
    """
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("seen"), F.lit(0).alias("kept"))

    def take(state: Column, m: Column) -> Column:
        used, seen = state["used"] + _count(m), state["seen"] + 1
        fits = used + F.coalesce(head_lead, _lead(m)) <= budget
        return F.struct(
            used.alias("used"),
            seen.alias("seen"),
            F.when(fits, seen).otherwise(state["kept"]).alias("kept"),
        )

    return F.aggregate(F.reverse(middle), start, take)["kept"]


def drop_middle(df: DataFrame, limit: int) -> DataFrame:
    """Add ``over``, ``dropped`` and ``dropped_turns``: how many of the oldest middle messages go.

    ``dropped`` counts messages of the array, ``dropped_turns`` also those that were left
    out before assembly. Needs the anchors. A middle of which not even the last message fits is
    dropped whole; whether the anchors alone fit is left to the next step.
    """
    messages, head, tail = F.col("messages"), F.col("head"), F.col("tail_start")
    raw = total(messages) + _lead(F.get(messages, F.lit(0))) + _skipped(df, SKIPPED_TOTAL)
    df = df.withColumn("raw_total", raw)
    df = df.withColumn("over", (F.col("raw_total") > limit) & tail.isNotNull())

    anchors = total(F.slice(messages, 1, head)) + total(
        F.slice(messages, tail + 1, F.size(messages) - tail)
    )
    df = df.withColumn("anchor_plain", F.when(F.col("over"), anchors))
    head_lead = F.when(head == 1, _lead(F.get(messages, F.lit(0))))
    middle = F.slice(messages, head + 1, tail - head)
    kept = _kept_middle(middle, head_lead, F.lit(limit) - F.col("anchor_plain"))
    first_lead = F.coalesce(head_lead, _lead(F.get(messages, tail)))
    return df.withColumns(
        {
            "dropped": F.when(F.col("over"), tail - head - kept).otherwise(0),
            "anchor_total": F.col("anchor_plain") + first_lead,
        }
    ).withColumn(
        "dropped_turns", F.when(F.col("over"), F.col("dropped") + _skipped(df, SKIPPED_MIDDLE)).otherwise(0)
    ).drop("anchor_plain")


def _halvings(m: Column) -> Column:
    """``(chars, count)`` for the first ``length >> k`` characters of the reasoning, down to one.

    Think tags are tokens of their own, so only the text between them is
    counted again, with the line ends that may merge with it.
    """
    reasoning = m["reasoning_content"]
    steps = F.sequence(F.lit(0), F.length(F.bin(F.length(reasoning))) - 1)
    lengths = F.transform(
        steps, lambda k: F.call_function("shiftright", F.length(reasoning), k)
    )

    def inner(n: Column) -> Column:
        return token_count(F.concat(F.lit("\n"), F.substr(reasoning, F.lit(1), n), F.lit("\n")))

    return F.transform(lengths, lambda n: F.struct(n.alias("chars"), inner(n).alias("count")))


def _first_fit(tried: Column, m: Column, budget: Column) -> Column:
    """``(chars, count)`` of the message with the longest halving that fits, else without reasoning."""
    rest = _count(m) - F.get(tried, F.lit(0))["count"]
    whole = F.transform(
        tried, lambda t: F.struct(t["chars"].alias("chars"), (t["count"] + rest).alias("count"))
    )
    cleared = F.struct(
        F.lit(0).alias("chars"), token_count(msg.render(m, F.lit(""))).alias("count")
    )
    return F.coalesce(F.get(F.filter(whole, lambda t: t["count"] <= budget), F.lit(0)), cleared)


def halve_reasoning(df: DataFrame, limit: int) -> DataFrame:
    """Add ``first_cut`` and ``last_cut``: shortened reasoning of the tail's messages.

    Applies once the middle is gone. Only the first two tail messages can be
    assistants; the second is touched after the first has lost all of its
    reasoning in vain. NULL leaves a message as it is.
    """
    tail, anchors = F.col("tail_start"), F.col("anchor_total")
    one, two = F.get("messages", tail), F.get("messages", tail + 1)
    alone = F.col("over") & (F.col("dropped") == tail - F.col("head"))

    def shortens(m: Column) -> Column:
        return alone & F.coalesce(msg.has_reasoning(m), F.lit(False))

    tried = F.col("tried")
    df = with_computed(df, {"tried": F.when(shortens(one), _halvings(one))})
    budget = F.lit(limit) - anchors + _count(one)
    df = with_computed(df, {"first_cut": F.when(tried.isNotNull(), _first_fit(tried, one, budget))})

    cut = F.col("first_cut")
    saved = F.coalesce(_count(one) - cut["count"], F.lit(0))
    settled = F.coalesce(cut["chars"] > 0, F.lit(False))
    df = with_computed(df, {"tried": F.when(shortens(two) & ~settled, _halvings(two))})
    budget = F.lit(limit) - anchors + saved + _count(two)
    df = with_computed(df, {"last_cut": F.when(tried.isNotNull(), _first_fit(tried, two, budget))})
    return df.drop("tried")


def _shorten(m: Column, cut: Column) -> Column:
    short = F.substr(m["reasoning_content"], F.lit(1), cut["chars"])
    return m.withField("reasoning_content", short).withField("tokens", tokens(msg.render(m, short)))


def _kept_messages() -> Column:
    messages, head = F.col("messages"), F.col("head")
    gone, first_cut, last_cut = F.col("dropped"), F.col("first_cut"), F.col("last_cut")
    kept = F.concat(
        F.slice(messages, 1, head),
        F.slice(messages, head + gone + 1, F.size(messages) - head - gone),
    )
    shortened = F.transform(
        kept,
        lambda m, i: F.when((i == head) & first_cut.isNotNull(), _shorten(m, first_cut))
        .when((i == head + 1) & last_cut.isNotNull(), _shorten(m, last_cut))
        .otherwise(m),
    )
    return (
        F.when(first_cut.isNotNull() | last_cut.isNotNull(), shortened)
        .when(gone > 0, kept)
        .otherwise(messages)
    )


def _with_tool_tokens(tools: Column) -> Column:
    """Tokens of the first message including the tool schemas."""
    with_tools = F.transform(
        "messages",
        lambda m, i: F.when(i == 0, m.withField("tokens", tokens(msg.render_first(m, tools)))).otherwise(m),
    )
    return F.when(tools.isNull(), F.col("messages")).otherwise(with_tools)


def truncate_messages(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Fit ``messages`` and add ``raw_length``, ``structured_length`` and ``stage``.

    ``stage`` tells how far it went: fits, middle, reasoning or tokens (still
    too long, so the token cut has to act).
    """
    limit, columns = opts.limit, df.columns
    if not limit:
        fitted = df.withColumn("messages", _with_tool_tokens(F.col("tools")))
        return fitted.withColumn("raw_length", total(F.col("messages"))).withColumns(
            {"structured_length": F.col("raw_length"), "stage": F.lit("fits")}
        )
    df = halve_reasoning(drop_middle(truncation_anchors(df), limit), limit)
    full = F.length(F.get("messages", F.col("tail_start"))["reasoning_content"])
    last = F.length(F.get("messages", F.col("tail_start") + 1)["reasoning_content"])
    shortened = F.coalesce(F.col("first_cut")["chars"] < full, F.lit(False)) | F.coalesce(
        F.col("last_cut")["chars"] < last, F.lit(False)
    )
    df = df.withColumns(
        {
            "raw_length": F.col("raw_total"),
            "fitted_by": F.when(shortened, "reasoning")
            .when(F.col("dropped") > 0, "middle")
            .otherwise("fits"),
        }
    )
    df = with_computed(df, {"messages": _kept_messages()})
    df = df.withColumn("messages", _with_tool_tokens(F.col("tools")))
    df = df.withColumn("structured_length", total(F.col("messages")) + _skipped(df, SKIPPED_TAIL))
    return df.withColumn(
        "stage",
        F.when(F.col("structured_length") > limit, "tokens").otherwise(F.col("fitted_by")),
    ).select(*columns, "raw_length", "structured_length", "stage")


def truncate_tokens(flat: Column, opts: PrepOptions, eos: Column | None) -> Column:
    """Last-resort cut of a ``(token, in_loss)`` array.

    Left keeps the end. Right keeps the start and closes it with ``eos``, a
    marker without loss unless the last kept token is one already.
    """
    limit = opts.limit
    if not limit:
        return flat
    if opts.truncate_side == "left":
        return F.when(F.size(flat) > limit, F.slice(flat, -limit, limit)).otherwise(flat)
    if eos is None:
        return F.slice(flat, 1, limit)
    ends = F.get(flat, F.lit(limit - 1))["token"] == eos["token"]
    closed = F.concat(F.slice(flat, 1, limit - 1), F.array(eos))
    return (
        F.when(F.size(flat) <= limit, flat)
        .when(ends, F.slice(flat, 1, limit))
        .otherwise(closed)
    )


def truncation_trace(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Add ``final_length`` to fitted conversations: raw, structured, final, stage."""
    final = F.col("structured_length")
    if opts.limit:
        final = F.least(final, F.lit(opts.limit))
    return df.withColumn("final_length", final)
