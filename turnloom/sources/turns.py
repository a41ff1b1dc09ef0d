"""Tables with one row per turn.

A conversation is a group of turns, and one group may hold a large part of the
table. So work on single messages stays at turn grain, totals are plain hash
aggregations (combined before the shuffle), running sums go over blocks of
turns, and a conversation becomes one array row only with a bounded number of
turns.

The order column is an integer that is unique within its conversation; it may count turns or
be a time of any resolution. Running sums go over a tree of order values of three levels, so
no window spans more than a fixed number of rows, however the values are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import message as msg
from ..functions.tokens import token_count, tokens
from ..operators.tools import resolve_tools_column
from ..operators.truncation import SKIPPED_MIDDLE, SKIPPED_TAIL, SKIPPED_TOTAL
from ..options import PrepOptions

# Turns to a row of assembled conversations; longer ones continue in further rows.
MAX_TURNS_PER_ROW = 4096
# Fewest tokens a rendered message can have: two markers and two line ends.
MIN_TOKENS_PER_MESSAGE = 4
# Order values per block of a running sum, and blocks per branch of the tree above them.
BLOCK_TURNS = 1 << 16
BLOCKS_PER_BRANCH = 1 << 24
# Sub-groups of each conversation when its turns are joined and ranked.
SALTS = 16

HAS_LOSS_ROLE = "has_loss_role"

# Message fields kept in array rows.
ROW_FIELDS = ("pos", "role", "content", "reasoning_content", "tool_calls", "name")


def message_columns() -> msg.Fields:
    """The message fields of a canonical turn table as plain columns."""
    names = (*msg.MESSAGE_TYPE.fieldNames(), "open", "close")
    return {name: F.col(name) for name in names}


def assemble_conversations(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    max_turns: int = MAX_TURNS_PER_ROW,
) -> DataFrame:
    """``key, part, messages``: turns in order, at most ``max_turns`` to a row.

    Parts go by rank: turns 0 to ``max_turns - 1`` of a conversation are part 0, the next
    ones part 1, and so on, whatever the values of ``order``. Nothing is cut off and
    no group grows without bound.
    """
    turn = F.struct(
        F.col(order).alias("pos"), F.col(role).alias("role"), F.col(text).alias("content")
    )
    ranked = running_total(turns.select(key, order, role, text), key, order, F.lit(1), "rank")
    part = F.floor(F.col("rank") / max_turns).cast("long").alias("part")
    grouped = ranked.select(key, part, turn.alias("m")).groupBy(key, "part")
    messages = F.array_sort(F.collect_list("m"))
    return grouped.agg(
        F.transform(messages, lambda m: m.dropFields("pos")).alias("messages")
    )


def canonical_turns(
    turns: DataFrame,
    opts: PrepOptions = PrepOptions(),
    key: str = "conv_id",
    order: str = "turn",
    text: str = "text",
) -> DataFrame:
    """Canonical messages at turn grain: ``key``, ``tools``, message fields, ``is_dropped``.

    Narrow, with one flat column per field. Blank system turns are gone. Think
    turns to be dropped are still there, flagged, because reports count them.
    """
    renamed = turns if text == "content" else turns.withColumnRenamed(text, "content")
    tools = resolve_tools_column(renamed)
    source = T.StructType([f for f in renamed.schema if f.name not in (key, order, tools)])
    row = {f.name: F.col(f.name) for f in source}
    fields = msg.from_source(row, source, F.col(order), opts)
    df = renamed.select(
        key,
        (F.col(tools) if tools else F.lit(None).cast("string")).alias("tools"),
        *[c.alias(name) for name, c in fields.items()],
    )
    m = message_columns()
    df = df.filter(~msg.is_blank_system(m))
    if opts.extract_think_tags:
        df = df.withColumns(msg.think_block(m))
        df = df.withColumns(msg.cut_think_block(m)).drop("open", "close")
    df = df.withColumn("is_dropped", msg.is_dropped_think(m, opts))
    policy = msg.think_policy(m, opts)
    return df.withColumns(policy) if policy else df


def running_totals(
    df: DataFrame,
    key: str,
    order: str,
    values: dict[str, Column],
    block: int = BLOCK_TURNS,
    branch: int = BLOCKS_PER_BRANCH,
    keep: bool = False,
) -> DataFrame:
    """Add the sums of ``values`` over the earlier rows of the same key; NULL is a key as well.

    Prefix sums over a tree: rows are summed to blocks of order values and blocks to branches,
    and a row's sum is that of the branches, blocks and rows before it. Order values are unique
    integers, so a block has at most ``block`` rows, a branch ``branch`` blocks, and a key at
    most 2^64 / (block * branch) branches; windows never span more. Only blocks that have rows
    exist: dense values give few, sparse ones at most one a row. ``keep`` leaves the columns
    ``_group`` and ``_block``, by which the result is partitioned.
    """
    # A struct compares equal where its field is NULL, unlike the bare key.
    group = {"_group": F.struct(key), "_block": F.floor(F.col(order) / block)}
    df = df.withColumns({**{f"_value_{n}": v for n, v in values.items()}, **group})

    def sums(name: str) -> list[Column]:
        return [F.sum(f"{name}_{n}").alias(f"_value_{n}") for n in values]

    def before(parts: tuple[str, ...], place: str, name: str) -> dict[str, Column]:
        w = Window.partitionBy(*parts).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return {f"{name}_{n}": F.coalesce(F.sum(f"_value_{n}").over(w), F.lit(0)) for n in values}

    blocks = df.groupBy("_group", "_block").agg(*sums("_value")).withColumn("_branch", F.floor(F.col("_block") / branch))
    branches = blocks.groupBy("_group", "_branch").agg(*sums("_value"))
    above = branches.withColumns(before(("_group",), "_branch", "_above")).drop(*[f"_value_{n}" for n in values])
    starts = blocks.withColumns(before(("_group", "_branch"), "_block", "_start")).join(above, ["_group", "_branch"])
    starts = starts.select("_group", "_block", *[(F.col(f"_start_{n}") + F.col(f"_above_{n}")).alias(f"_start_{n}") for n in values])
    # The key itself, too, so that filters on it move below the window.
    inside = before((key, "_group", "_block"), order, "_inside")
    summed = df.join(starts, ["_group", "_block"]).withColumns(
        {n: F.col(f"_start_{n}") + inside[f"_inside_{n}"] for n in values}
    )
    extra = [f"{c}_{n}" for c in ("_value", "_start") for n in values]
    return summed.drop(*extra) if keep else summed.drop(*extra, "_group", "_block")


def running_total(
    df: DataFrame, key: str, order: str, value: Column, name: str, block: int = BLOCK_TURNS, keep: bool = False
) -> DataFrame:
    """One running sum; see :func:`running_totals`."""
    return running_totals(df, key, order, {name: value}, block, keep=keep)


def salted(conversations: DataFrame, key: str) -> DataFrame:
    """``_group, _salt`` for the key: one copy of a conversation's row for each sub-group of its turns."""
    return conversations.withColumns(
        {"_group": F.struct(key), "_salt": F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))}
    ).drop(key)


def with_conversation(
    turns: DataFrame, conversations: DataFrame, key: str, order: str = "pos", how: str = "inner"
) -> DataFrame:
    """Turns joined to the row of their conversation, in sub-groups, so that a huge one spreads."""
    salt = {"_group": F.struct(key), "_salt": F.pmod(F.hash(order), F.lit(SALTS))}
    return turns.withColumns(salt).join(salted(conversations, key), ["_group", "_salt"], how).drop("_group", "_salt")


def role_spans(
    pieces: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "rendered", keep: bool = False
) -> DataFrame:
    """Add ``span_start`` and ``span_end``: each message's characters in the whole text."""
    spans = running_total(pieces, key, order, F.length(text).cast("long"), "span_start", keep=keep)
    return spans.withColumn("span_end", F.col("span_start") + F.length(text))


def token_offsets(
    pieces: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "rendered"
) -> DataFrame:
    """One row per token with its ``[start, end)`` characters in the whole text.

    Tokens stay in the partition of their message.
    """
    listed = role_spans(pieces, key, order, text, keep=True).select(
        key, "_group", "_block", order, "span_start", F.posexplode(tokens(F.col(text))).alias("place", "token")
    )
    inside = (
        Window.partitionBy(key, "_group", "_block", order)
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("span_start") + F.sum(F.length("token")).over(inside)
    return (
        listed.withColumn("token_end", end)
        .withColumn("token_start", F.col("token_end") - F.length("token"))
        .select(key, order, "place", "token", "token_start", "token_end")
    )


def conversation_totals(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Parse report and token total per conversation of canonical turns, as sums.

    Dropped think turns count in ``dropped_think`` only.
    """
    kept = ~F.col("is_dropped")
    return turns.groupBy(key).agg(
        F.sum("extracted").alias("extracted_think"),
        F.sum("moved").alias("moved_reasoning"),
        F.count_if(~kept).alias("dropped_think"),
        F.min_by("tools", "pos").alias("tools"),
        F.count_if(kept).alias("n_messages"),
        F.sum(F.when(kept, token_count(msg.render(message_columns())))).alias("total_tokens"),
    )


def unknown_role_turns(turns: DataFrame, opts: PrepOptions, key: str = "conv_id") -> DataFrame:
    """Unknown roles per conversation with the place where each is first seen."""
    return (
        turns.filter(~F.col("is_dropped") & msg.is_unknown_role(F.col("role"), opts))
        .groupBy(key, "role")
        .agg(F.min("pos").alias("first_seen"))
    )


def _placed(turns: DataFrame, opts: PrepOptions, key: str) -> DataFrame:
    """Turns with ``trails`` (after the last assistant) and ``stays``: whether they can reach a sample.

    Every message has at least four tokens. So of the turns up to the last
    assistant only the last ``limit / 4 + 3`` can fit, and of the turns after
    it, when there are more than that, only those next to the kept side outlive
    the token cut. The first message always stays, as it may be the head. Turns are
    ranked in sub-groups, so at most that many stay in each of these.
    """
    most = opts.limit // MIN_TOKENS_PER_MESSAGE + 3
    pos = F.col("pos")
    ends = turns.groupBy(key).agg(
        F.min(pos).alias("first_pos"),
        F.max(F.when(F.col("role") == "assistant", pos)).alias("last_pos"),
    )
    salt = {"_group": F.struct(key), "_salt": F.pmod(F.hash(pos), F.lit(SALTS))}
    placed = turns.withColumns(salt).join(salted(ends, key), ["_group", "_salt"]).withColumn(
        "trails", F.coalesce(pos > F.col("last_pos"), F.lit(True))
    )
    from_end = F.lit(opts.truncate_side == "left") | ~F.col("trails")
    nearest = Window.partitionBy(key, "_group", "_salt", "trails").orderBy(F.when(from_end, -pos).otherwise(pos))
    return placed.withColumn("_rank", F.row_number().over(nearest)).withColumn(
        "stays", (pos == F.col("first_pos")) | (F.col("_rank") <= most)
    )


def fitting_conversations(
    turns: DataFrame,
    opts: PrepOptions = PrepOptions(),
    key: str = "conv_id",
    order: str = "turn",
    text: str = "text",
) -> DataFrame:
    """One array row per conversation of a turn table, ready for truncation.

    One rule for conversations of any size: a row gathers the turns that truncation
    could keep, and of the others their token sums and their number, so every length
    and count stays exact. With truncation off a sample holds the whole conversation, and
    so does its row; lengths alone come from ``conversation_totals`` without assembly.
    """
    canonical = canonical_turns(turns, opts, key, order, text)
    kept = canonical.filter(~F.col("is_dropped")).drop("is_dropped")
    if not opts.limit:
        placed = kept.withColumns({"stays": F.lit(True), "trails": F.lit(False)})
    else:
        placed = _placed(kept, opts, key)
    left_out, trails = ~F.col("stays"), F.col("trails")
    # Only turns that are left out are counted here; the others are tokenised later.
    n = F.when(left_out, token_count(msg.render(message_columns())).cast("long")).otherwise(0)
    sized = placed.withColumn("_n", n)
    return sized.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("stays"), F.struct(*ROW_FIELDS)))).alias("messages"),
        F.min_by("tools", "pos").alias("tools"),
        F.max(F.col("role").isin(opts.loss_roles)).alias(HAS_LOSS_ROLE),
        F.sum("_n").alias(SKIPPED_TOTAL),
        F.sum(F.when(trails, F.col("_n")).otherwise(0)).alias(SKIPPED_TAIL),
        F.count_if(left_out & ~trails).alias(SKIPPED_MIDDLE),
    )
