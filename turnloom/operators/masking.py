"""Loss marks and labels.

A message of a loss-bearing role is in loss with its header and end marker.
Think tags are tokens of their own, so marks are set per token and no
character mask is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.barrier import with_computed
from ..functions.tokens import EOS_TOKEN, IGNORED_LABEL, THINK_CLOSE, THINK_OPEN, token_id
from ..options import PrepOptions


def mark_spans(m: Column, opts: PrepOptions) -> Column:
    """Add ``in_loss`` and the 1-based places of the think tags to a tokenised message.

    The tags count only if the first closing one follows the first opening one;
    otherwise both places are 0.
    """
    start = F.array_position(m["tokens"], F.lit(THINK_OPEN))
    end = F.array_position(m["tokens"], F.lit(THINK_CLOSE))
    in_loss = m["role"].isin(opts.loss_roles)
    if opts.think_loss == "all":
        return m.withField("in_loss", in_loss)
    found = in_loss & (start > 0) & (end > start)
    return (
        m.withField("in_loss", in_loss)
        .withField("open_at", F.when(found, start).otherwise(0))
        .withField("close_at", F.when(found, end).otherwise(0))
    )


def token_in_loss(m: Column, place: Column, opts: PrepOptions) -> Column:
    """Is the token at 0-based ``place`` of a marked message in loss?"""
    if opts.think_loss == "answer_only":
        return m["in_loss"] & (place >= m["close_at"])
    if opts.think_loss == "answer_plus_think":
        return m["in_loss"] & (place != m["open_at"] - 1) & (place != m["close_at"] - 1)
    return m["in_loss"]


def marked_tokens(m: Column, opts: PrepOptions) -> Column:
    return F.transform(
        m["tokens"],
        lambda t, i: F.struct(t.alias("token"), token_in_loss(m, i, opts).alias("in_loss")),
    )


def loss_tokens(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Add ``marked``: all ``(token, in_loss)`` pairs of the conversation in order."""
    spans = F.transform("messages", lambda m: mark_spans(m, opts))
    df = df.withColumn("messages", spans)
    return df.withColumn(
        "marked", F.flatten(F.transform("messages", lambda m: marked_tokens(m, opts)))
    )


def end_marker() -> Column:
    """The closing token of a right cut; it carries no loss."""
    return F.struct(F.lit(EOS_TOKEN).alias("token"), F.lit(False).alias("in_loss"))


def labels(df: DataFrame) -> DataFrame:
    """Turn ``marked`` into ``input_ids`` and ``labels`` (-100 outside loss)."""
    coded = F.transform(
        "marked",
        lambda t: F.struct(token_id(t["token"]).alias("id"), t["in_loss"].alias("in_loss")),
    )
    df = with_computed(df, {"coded": coded})
    return df.withColumns(
        {
            "input_ids": F.col("coded.id"),
            "labels": F.transform(
                "coded", lambda c: F.when(c["in_loss"], c["id"]).otherwise(IGNORED_LABEL)
            ),
        }
    ).drop("coded")


def token_labels_long(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """One row per token of tokenised conversations: message, place, token, role, in_loss."""
    rest = [c for c in df.columns if c != "messages"]
    per_message = df.select(*rest, F.posexplode("messages").alias("message_index", "m"))
    marked = per_message.withColumn("m", mark_spans(F.col("m"), opts))
    return marked.select(
        *rest,
        "message_index",
        F.col("m.pos").alias("pos"),
        F.col("m.role").alias("role"),
        F.posexplode(marked_tokens(F.col("m"), opts)).alias("place", "t"),
    ).select(*rest, "message_index", "pos", "role", "place", "t.token", "t.in_loss")


def loss_segments(text: Column, role: Column, opts: PrepOptions) -> Column:
    """A rendered message as ``(text, in_loss)`` pieces: one, or two or five around think tags."""
    start, end = F.locate(THINK_OPEN, text), F.locate(THINK_CLOSE, text)
    in_loss = role.isin(opts.loss_roles)

    def piece(first: Column, stop: Column, flag: bool) -> Column:
        return F.struct(
            F.substr(text, first, stop - first).alias("text"), F.lit(flag).alias("in_loss")
        )

    whole = F.array(F.struct(text.alias("text"), in_loss.alias("in_loss")))
    if opts.think_loss == "all":
        return whole
    first, stop = F.lit(1), F.length(text) + 1
    opened, closed = start + len(THINK_OPEN), end + len(THINK_CLOSE)
    if opts.think_loss == "answer_only":
        split = F.array(piece(first, closed, False), piece(closed, stop, True))
    else:
        split = F.array(
            piece(first, start, True),
            piece(start, opened, False),
            piece(opened, end, True),
            piece(end, closed, False),
            piece(closed, stop, True),
        )
    return F.when(in_loss & (start > 0) & (end > start), split).otherwise(whole)
