"""Sample preparation with a caller's tokenizer.

Same rules as :mod:`turnloom.plans.prepare`, but every count is a count of a
whole candidate text. For message-list and prompt/response tables.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import message as msg
from ..functions.external_tokenizer import ExternalTokenizer
from ..functions.tokens import IGNORED_LABEL, IM_END, attention_mask
from ..operators import masking, rendering, truncation
from ..options import PrepOptions
from .prepare import canonical_rows, drop_empty_samples, project_samples


def _capped(df: DataFrame, tokenizer: ExternalTokenizer, opts: PrepOptions) -> DataFrame:
    """Cap think turns and reasoning by the tokenizer's own count."""
    if opts.drops_thinking or not opts.token_cap:
        return df

    def each(pick) -> Column:
        return tokenizer.cap(F.transform("messages", pick), opts.token_cap)

    df = df.withColumns(
        {
            "capped_reasoning": each(lambda m: m["reasoning_content"]),
            "capped_content": each(lambda m: F.when(m["role"] == opts.think_role, m["content"])),
        }
    )
    capped = F.transform(
        "messages",
        lambda m, i: m.withField("reasoning_content", F.get("capped_reasoning", i)).withField(
            "content", F.coalesce(F.get("capped_content", i), m["content"])
        ),
    )
    return df.withColumn("messages", capped).drop("capped_reasoning", "capped_content")


def _choice(tokenizer: ExternalTokenizer, limit: int) -> Column:
    """What to drop and cut in rows that are over the limit (NULL for the others)."""
    messages, tools = F.col("messages"), F.col("tools")
    head, tail = F.col("head"), F.col("tail_start")
    leads = head == 0
    middle = F.slice(messages, head + 1, tail - head)

    def leading(m: Column) -> Column:
        return F.when(leads, msg.render_first(m, tools)).otherwise(msg.render(m))

    def block(m: Column, i: Column) -> Column:
        """A tail message around its reasoning; ``alone`` is how it starts without a middle."""
        shortens = msg.has_reasoning(m)
        before = F.when(shortens, msg.opening(m)).otherwise(msg.render(m))
        schemas = F.coalesce(msg.tools_block(tools), F.lit(""))
        carrying = F.when(shortens, F.concat(schemas, before)).otherwise(leading(m))
        return F.struct(
            before.alias("before"),
            F.when(leads & (i == 0), carrying).otherwise(before).alias("alone"),
            F.when(shortens, m["reasoning_content"]).alias("reasoning"),
            F.when(shortens, F.concat(msg.answer(m), F.lit(IM_END + "\n")))
            .otherwise("")
            .alias("after"),
        )

    head_text = F.when(leads, "").otherwise(msg.render_first(F.get(messages, F.lit(0)), tools))
    rest = F.slice(messages, tail + 3, F.greatest(F.size(messages) - tail - 2, F.lit(0)))
    over = F.coalesce((F.col("raw_length") > limit) & tail.isNotNull(), F.lit(False))
    return tokenizer.choose(
        F.when(over, head_text),
        F.when(over, F.transform(middle, leading)),
        F.when(over, F.transform(middle, lambda m: msg.render(m))),
        F.when(over, F.transform(F.slice(messages, tail + 1, 2), block)),
        F.when(over, F.array_join(F.transform(rest, lambda m: msg.render(m)), "")),
        limit,
    )


def _fit(df: DataFrame, tokenizer: ExternalTokenizer, limit: int) -> DataFrame:
    df = df.withColumn(
        "raw_length", tokenizer.count(F.array_join(rendering.message_texts(), ""))
    )
    if not limit:
        return df
    df = truncation.truncation_anchors(df).withColumn("choice", _choice(tokenizer, limit))
    head, gone, cuts = F.col("head"), F.col("choice.dropped"), F.col("choice.cuts")
    kept = F.concat(
        F.slice("messages", 1, head),
        F.slice("messages", head + gone + 1, F.size("messages") - head - gone),
    )

    def shortened(m: Column, i: Column) -> Column:
        at_tail = i - (F.col("tail_start") - gone)
        chars = F.when(at_tail.between(0, 1), F.get(cuts, at_tail))
        reasoning = m["reasoning_content"]
        return m.withField(
            "reasoning_content",
            F.when(chars.isNotNull(), F.substr(reasoning, F.lit(1), chars)).otherwise(reasoning),
        )

    fitted = F.when(gone.isNotNull(), F.transform(kept, shortened))
    return df.withColumn("messages", F.coalesce(fitted, F.col("messages")))


def prepare_samples_with(
    df: DataFrame,
    tokenizer: ExternalTokenizer,
    opts: PrepOptions = PrepOptions(),
    keep: tuple[str, ...] = ("conv_id",),
) -> DataFrame:
    """Training samples under the caller's tokenizer; columns as in ``prepare_samples``."""
    rows = canonical_rows(df, replace(opts, think_max_tokens=0), keep)
    fitted = _fit(_capped(rows, tokenizer, opts), tokenizer, opts.limit)
    texts = rendering.message_texts()
    segments = F.flatten(
        F.zip_with(
            texts, F.col("messages"), lambda t, m: masking.loss_segments(t, m["role"], opts)
        )
    )
    coded = fitted.withColumn("segments", segments).withColumn(
        "coded", tokenizer.marked_ids(F.col("segments.text"), F.col("segments.in_loss"))
    )
    eos = None
    if tokenizer.eos_id is not None:
        eos = F.struct(
            F.lit(tokenizer.eos_id).cast("long").alias("token"), F.lit(False).alias("in_loss")
        )
    flat = F.arrays_zip(F.col("coded.ids").alias("token"), F.col("coded.in_loss").alias("in_loss"))
    cut = coded.withColumn("flat", flat).withColumn(
        "flat", truncation.truncate_tokens(F.col("flat"), opts, eos)
    )
    samples = cut.withColumns(
        {
            "input_ids": F.col("flat.token"),
            "labels": F.transform(
                "flat", lambda t: F.when(t["in_loss"], t["token"]).otherwise(IGNORED_LABEL)
            ),
            "original_length": F.size("coded.ids"),
        }
    ).withColumn("attention_mask", attention_mask(F.col("input_ids")))
    return project_samples(drop_empty_samples(samples), keep)
