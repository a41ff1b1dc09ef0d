"""Prompts from the history of a conversation, one for each user turn.

The history of a user turn is every turn before it, so whole histories together grow with the
square of a conversation. The index is linear instead: a row for each user turn with the first
turn of its history that a token budget allows, found in the prefix sums of the turns' tokens.
Texts are gathered for that range only, so each prompt is as long as the budget at most, or
as its user turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import message as msg
from ..functions.text import strip
from ..functions.tokens import IM_END, IM_START, token_count
from ..options import PrepOptions
from ..sources import turns as turn_ops
from .rendering import DEFAULT_SYSTEM

OPEN_TURN = f"{IM_START}assistant\n"
DEFAULT_HEAD = f"{IM_START}system\n{DEFAULT_SYSTEM}{IM_END}\n"


def history_turns(
    turns: DataFrame, opts: PrepOptions = PrepOptions(), key: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """``key, pos, role, rendered, n_tokens, before``: turns as a chat loop remembers them.

    Texts of users and assistants are trimmed, and blank user turns leave no trace. ``before``
    is the token sum of the turns before.
    """
    canonical = turn_ops.canonical_turns(turns, opts, key, order, text)
    said = F.col("role").isin("user", "assistant")
    trimmed = canonical.filter(~F.col("is_dropped")).withColumn(
        "content", F.when(said, strip(F.col("content"))).otherwise(F.col("content"))
    )
    kept = trimmed.filter(~((F.col("role") == "user") & (F.col("content") == "")))
    rendered = kept.select(key, "pos", "role", msg.render(turn_ops.message_columns()).alias("rendered"))
    sized = rendered.withColumn("n_tokens", token_count(F.col("rendered")).cast("long"))
    return turn_ops.running_total(sized, key, "pos", F.col("n_tokens"), "before")


def _heads(history: DataFrame, key: str) -> DataFrame:
    """``key, head, head_tokens, first_pos``: the system turn that opens a conversation, or the default one."""
    first = history.groupBy(key).agg(F.min_by(F.struct("role", "rendered", "n_tokens"), "pos").alias("m"), F.min("pos").alias("first_pos"))
    own = F.col("m.role") == "system"
    return first.select(
        key,
        F.when(own, F.col("m.rendered")).otherwise(F.lit(DEFAULT_HEAD)).alias("head"),
        F.when(own, F.col("m.n_tokens")).otherwise(token_count(F.lit(DEFAULT_HEAD))).cast("long").alias("head_tokens"),
        F.when(own, F.col("first_pos")).alias("head_pos"),
    )


def history_index(history: DataFrame, budget: int, key: str = "conv_id") -> DataFrame:
    """One row per user turn of :func:`history_turns`: ``key, turn, first_turn, n_tokens, head, _from, _to``.

    ``first_turn`` is the earliest turn from which all turns up to the user turn, the opening
    system turn and the open assistant turn have at most ``budget`` tokens; the user turn
    itself always stays. ``n_tokens`` is that sum, and ``[_from, _to]`` are the places of the first
    and the last turn in the running sum.

    The first turn at or after a place of the running sum is looked up in cells of ``budget``
    tokens: a turn stands in its own cell and the one before, a user turn asks in the cell of its
    place. A turn has at least four tokens, so cells are small whatever a conversation holds.
    """
    if budget <= 0:
        raise ValueError("budget must be positive")
    heads = _heads(history, key)
    opened = token_count(F.lit(OPEN_TURN))
    light = turn_ops.with_conversation(history.drop("rendered"), heads.select(key, "head_tokens", "head_pos"), key)
    listed = light.filter(F.col("head_pos").isNull() | (F.col("pos") != F.col("head_pos")))
    after = F.col("before") + F.col("n_tokens") + F.col("head_tokens") + opened
    user = F.col("role") == "user"
    # Later than the user turn itself where that alone is over the budget.
    place = F.least(F.greatest(after - budget, F.lit(0)), F.col("before"))
    cell = F.floor(F.col("before") / budget)
    none = F.lit(None).cast("long")

    def entry(cell: Column, at: Column, start: Column, turn: Column, total: Column) -> Column:
        names = ("cell", "at", "start", "turn", "total")
        return F.struct(*[c.cast("long").alias(n) for n, c in zip(names, (cell, at, start, turn, total))])

    stands = [entry(cell - i, F.col("before"), F.col("before"), none, none) for i in (0, 1)]
    asks = entry(F.floor(place / budget), place, none, F.col("pos"), after)
    entries = F.when(user, F.array(*stands, asks)).otherwise(F.array(*stands))
    rows = listed.select(key, F.col("pos"), F.struct(key).alias("_group"), F.explode(entries).alias("e")).select(
        key, "_group", F.when(F.col("e.start").isNotNull(), F.col("pos")).alias("stands"), "e.*"
    )
    # At one place the question comes first, so that it finds the turn that starts there.
    following = (
        Window.partitionBy("_group", "cell")
        .orderBy("at", F.col("turn").isNull())
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    found = rows.withColumns(
        {"first_turn": F.first("stands", ignorenulls=True).over(following), "_from": F.first("start", ignorenulls=True).over(following)}
    ).filter(F.col("turn").isNotNull())
    asked = turn_ops.with_conversation(found, heads.select(key, "head", "head_tokens"), key, "turn")
    return asked.select(
        key,
        "turn",
        "first_turn",
        (F.col("total") - F.col("_from")).alias("n_tokens"),
        "head",
        "_from",
        (F.col("total") - F.col("head_tokens") - opened).alias("_to"),
    )


def history_prompts(
    turns: DataFrame,
    budget: int,
    opts: PrepOptions = PrepOptions(),
    key: str = "conv_id",
    order: str = "turn",
    text: str = "text",
) -> DataFrame:
    """``key, turn, first_turn, n_turns, n_tokens, prompt``: one prompt per non-blank user turn.

    The opening system turn (or the default one), the turns of the history that fit the budget,
    the user turn, and an open assistant turn. Index rows and turns meet in cells of the
    running sum, so a huge conversation spreads.
    """
    history = history_turns(turns, opts, key, order, text)
    index = history_index(history, budget, key)
    first, last = F.floor(F.col("_from") / budget), F.floor((F.col("_to") - 1) / budget)
    # A user turn over the budget spans many cells but stands in the cell of its start alone.
    spans = F.sequence(first, F.greatest(first, F.least(last, first + 1)))
    asked = index.withColumns({"_group": F.struct(key), "_cell": F.explode(spans)})
    texts = history.select(
        F.struct(key).alias("_group"), F.floor(F.col("before") / budget).alias("_cell"), "pos", "before", "rendered"
    )
    inside = (F.col("before") >= F.col("_from")) & (F.col("before") < F.col("_to"))
    met = asked.join(texts, ["_group", "_cell"]).filter(inside)
    gathered = met.groupBy("_group", key, "turn").agg(
        F.first("first_turn").alias("first_turn"),
        F.first("n_tokens").alias("n_tokens"),
        F.first("head").alias("head"),
        F.array_sort(F.collect_list(F.struct("pos", "rendered"))).alias("m"),
    )
    prompt = F.concat("head", F.array_join("m.rendered", ""), F.lit(OPEN_TURN))
    return gathered.select(
        key, "turn", "first_turn", F.size("m").cast("long").alias("n_turns"), "n_tokens", prompt.alias("prompt")
    )
