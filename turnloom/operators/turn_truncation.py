"""Truncation by whole messages at turn grain: no array per conversation.

What stays follows from prefix sums of the turns' tokens. The turns of the tail are found by
their rank, and the first turn that fits is the smallest rank whose suffix of the middle is
within the budget: an aggregate over turns, combined before its shuffle. Per conversation
there are only sums, ranks, and the two messages whose reasoning may be shortened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import message as msg
from ..functions.tokens import token_count, tokens
from ..options import PrepOptions
from ..sources import turns as turn_ops
from . import canonical, truncation

MESSAGE = ("role", "content", "reasoning_content", "tool_calls", "name")


def _lead(m: msg.Message, n: Column, tools: Column) -> Column:
    """Tokens of the tool schemas if the message comes first."""
    inside = tools.isNotNull() & (m["role"] == "system")
    own_block = F.coalesce(token_count(msg.tools_block(tools)), F.lit(0))
    return F.when(inside, token_count(msg.render_first(m, tools)) - n).otherwise(own_block)


def ranked_turns(
    turns: DataFrame, opts: PrepOptions = PrepOptions(), key: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """Kept canonical turns with ``n`` tokens, their ``rank`` and the tokens ``before`` them."""
    canon = turn_ops.canonical_turns(turns, opts, key, order, text)
    kept = canon.filter(~F.col("is_dropped")).select(key, "pos", "tools", *MESSAGE)
    sized = kept.withColumn("n", token_count(msg.render(turn_ops.message_columns())))
    return turn_ops.running_totals(sized, key, "pos", {"rank": F.lit(1), "before": F.col("n")})


def _ends(ranked: DataFrame, opts: PrepOptions, key: str) -> DataFrame:
    """One row per conversation: tools, ``head``, ``tail`` (ranks), ``raw_total``, ``over``."""
    first = F.min_by(F.struct(*MESSAGE, "n"), "pos")
    ends = ranked.groupBy(key).agg(
        F.min_by("tools", "pos").alias("tools"),
        first.alias("first"),
        F.max(F.when(F.col("role") == "assistant", F.col("rank"))).alias("last"),
        F.max(F.col("role").isin(opts.loss_roles)).alias("has_loss"),
        F.sum("n").alias("plain"),
    )
    if opts.drop_if_no_assistant:
        ends = ends.filter("has_loss")
    ends = canonical.normalize_tools(ends)
    first = F.col("first")
    head = (first["role"] == "system").cast("int")
    ends = ends.withColumns({"head": head, "lead": _lead(first, first["n"], F.col("tools"))})
    raw = F.col("plain") + F.col("lead")
    tail = F.when(F.col("last").isNotNull(), F.greatest(F.col("head").cast("long"), F.col("last") - 1))
    over = F.lit(bool(opts.limit)) & (raw > opts.limit) & F.col("last").isNotNull()
    return ends.select(
        key,
        F.col("tools").alias("schemas"),
        "head",
        F.when(F.col("head") == 1, F.col("lead")).alias("head_lead"),
        (F.col("head") * first["n"]).alias("head_n"),
        "plain",
        tail.alias("tail"),
        raw.alias("raw_total"),
        over.alias("over"),
    )


def _decided(placed: DataFrame, limit: int, key: str) -> DataFrame:
    """One row per conversation over the budget: ``from_rank``, ``anchors`` and the tail's first two messages.

    Keeping the turns from some rank on costs the head, all tokens from there to the end, and
    the schemas in the head or in the first turn that stays. ``from_rank`` is NULL where not even
    the last turn of the middle fits.
    """
    rank, tail, head = F.col("rank"), F.col("tail"), F.col("head")
    lead = F.coalesce("head_lead", _lead(turn_ops.message_columns(), F.col("n"), F.col("schemas")))
    middle = (rank >= head) & (rank < tail)
    total = F.col("head_n") + F.col("plain") - F.col("before")
    message = F.struct(*MESSAGE, "n")
    constant = ("over", "head", "head_lead", "schemas")
    return placed.filter("over").groupBy(key).agg(
        F.min(F.when(middle & (total + lead <= limit), rank)).alias("from_rank"),
        F.max(F.when(rank == tail, total)).alias("anchors"),
        F.max(F.when(rank == tail, message)).alias("one"),
        F.max(F.when(rank == tail + 1, message)).alias("two"),
        *[F.first(c).alias(c) for c in constant],
    )


def _shortened(decided: DataFrame, limit: int) -> DataFrame:
    """Add ``first_chars`` and ``last_chars``: what stays of the reasoning of the tail's first two messages."""
    pair = F.filter(F.array("one", "two"), lambda m: m.isNotNull())
    messages = F.transform(pair, lambda m: m.withField("tokens", tokens(msg.render(m))))
    plain = F.col("anchors") + F.coalesce("head_lead", _lead(F.col("one"), F.col("one.n"), F.col("schemas")))
    alone = F.col("over") & F.col("from_rank").isNull()
    mini = decided.withColumns(
        {
            "messages": messages,
            "anchor_total": plain,
            "tail_start": F.lit(0),
            "_head": F.col("head"),
            "head": F.lit(0),
            "dropped": F.when(alone, 0).otherwise(1),
        }
    )
    cut = truncation.halve_reasoning(mini, limit)
    return cut.withColumns(
        {"first_chars": F.col("first_cut.chars"), "last_chars": F.col("last_cut.chars"), "head": F.col("_head")}
    )


def placed_turns(
    turns: DataFrame, opts: PrepOptions = PrepOptions(), key: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """Every kept canonical turn with what is decided about its conversation.

    ``schemas, head, tail, raw_total, over`` as in the array form, ``from_rank`` (the first turn
    after the head that stays), ``first_chars`` and ``last_chars``. All joins to turns go by
    sub-groups of a conversation.
    """
    ranked = ranked_turns(turns, opts, key, order, text)
    placed = turn_ops.with_conversation(ranked.drop("tools"), _ends(ranked, opts, key), key)
    if not opts.limit:
        none = F.lit(None).cast("int")
        return placed.withColumns({"from_rank": F.col("head").cast("long"), "first_chars": none, "last_chars": none})
    cuts = _shortened(_decided(placed, opts.limit, key), opts.limit)
    cuts = cuts.select(key, "from_rank", "first_chars", "last_chars", F.lit(True).alias("cut"))
    # Conversations within the budget have no row in `cuts`.
    start = F.coalesce("from_rank", F.when(F.col("cut"), F.col("tail")).otherwise(F.col("head")))
    return turn_ops.with_conversation(placed, cuts, key, how="left").withColumn("from_rank", start).drop("cut")


def cut_turns(turns: DataFrame, opts: PrepOptions = PrepOptions(), **columns) -> DataFrame:
    """Turns that stay, as ``key, pos, role, content, reasoning_content, rendered``.

    Reasoning is shortened and the first message carries the tool schemas.
    """
    key = columns.get("key", "conv_id")
    placed = placed_turns(turns, opts, **columns)
    rank = F.col("rank")
    heads = (rank == 0) & (F.col("head") == 1)
    kept = placed.filter(heads | (rank >= F.col("from_rank")))
    chars = F.when(rank == F.col("tail"), F.col("first_chars")).when(rank == F.col("tail") + 1, F.col("last_chars"))
    reasoning = F.col("reasoning_content")
    kept = kept.withColumn("_chars", chars).withColumn(
        "reasoning_content",
        F.when(F.col("_chars").isNotNull(), F.substr(reasoning, F.lit(1), F.col("_chars"))).otherwise(reasoning),
    )
    fields = turn_ops.message_columns()
    leads = heads | ((F.col("head") == 0) & (rank == F.col("from_rank")))
    text = F.when(leads, msg.render_first(fields, F.col("schemas"))).otherwise(msg.render(fields))
    return kept.select(key, "pos", "role", "content", "reasoning_content", text.alias("rendered"))
