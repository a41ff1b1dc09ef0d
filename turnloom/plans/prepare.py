"""From conversations to samples, lengths and debug views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.tokens import attention_mask
from ..operators import canonical, masking, rendering, truncation, turn_truncation
from ..options import PrepOptions
from ..sources.turns import HAS_LOSS_ROLE, fitting_conversations

SAMPLE_COLUMNS = ("input_ids", "attention_mask", "labels", "original_length", "raw_length")


def project_samples(df: DataFrame, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Keys and sample columns only."""
    return df.select(*keep, *SAMPLE_COLUMNS)


def drop_empty_samples(df: DataFrame) -> DataFrame:
    return df.filter(F.size("input_ids") > 0)


def canonical_rows(df: DataFrame, opts: PrepOptions, keep: tuple[str, ...]) -> DataFrame:
    """Canonical rows that will give a sample."""
    return canonical.canonicalize(canonical.usable_rows(df, opts), opts, keep)


def turn_rows(turns: DataFrame, opts: PrepOptions, **columns) -> DataFrame:
    """Canonical array rows of a turn table, with loss roles checked on the whole conversation."""
    rows = fitting_conversations(turns, opts, **columns)
    if opts.drop_if_no_assistant:
        rows = rows.filter(HAS_LOSS_ROLE)
    return with_tools(rows.drop(HAS_LOSS_ROLE))


def with_tools(df: DataFrame) -> DataFrame:
    return canonical.normalize_tools(df).drop("tools_from_string")


def fit(rows: DataFrame, opts: PrepOptions) -> DataFrame:
    """Tokenise and truncate canonical rows."""
    return truncation.truncate_messages(rendering.tokenize_messages(rows), opts)


def fitted_turns(
    turns: DataFrame, opts: PrepOptions, key: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """Every turn that truncation by whole messages keeps: ``key``, ``pos``, fields, ``rendered``.

    Decided from prefix sums, without an array per conversation, so long runs of turns after
    the last assistant are listed in full.
    """
    return turn_truncation.cut_turns(turns, opts, key=key, order=order, text=text)


def _samples(rows: DataFrame, opts: PrepOptions) -> DataFrame:
    marked = masking.loss_tokens(fit(rows, opts), opts)
    cut = marked.withColumn(
        "marked", truncation.truncate_tokens(F.col("marked"), opts, masking.end_marker())
    )
    return masking.labels(cut).withColumns(
        {
            "attention_mask": attention_mask(F.col("input_ids")),
            "original_length": F.col("structured_length"),
        }
    )


def prepare_samples(
    df: DataFrame, opts: PrepOptions = PrepOptions(), keep: tuple[str, ...] = ("conv_id",)
) -> DataFrame:
    """Training samples of a conversation table: one narrow stage, batch or stream."""
    return project_samples(_samples(canonical_rows(df, opts, keep), opts), keep)


def prepare_turn_samples(
    turns: DataFrame, opts: PrepOptions = PrepOptions(), key: str = "conv_id", **columns
) -> DataFrame:
    """Training samples of a turn table: turns are ranked, gathered by conversation, then narrow."""
    rows = turn_rows(turns, opts, key=key, **columns)
    return project_samples(_samples(rows, opts), (key,))


def _lengths(rows: DataFrame, opts: PrepOptions, keep: tuple[str, ...]) -> DataFrame:
    traced = truncation.truncation_trace(fit(rows, opts), opts)
    return traced.select(*keep, "raw_length", "structured_length", "final_length", "stage")


def prepare_lengths(
    df: DataFrame, opts: PrepOptions = PrepOptions(), keep: tuple[str, ...] = ("conv_id",)
) -> DataFrame:
    """Raw, structured and final token counts and the stage, without building samples."""
    return _lengths(canonical_rows(df, opts, keep), opts, keep)


def prepare_turn_lengths(
    turns: DataFrame, opts: PrepOptions = PrepOptions(), key: str = "conv_id", **columns
) -> DataFrame:
    """Like :func:`prepare_lengths` for a turn table."""
    return _lengths(turn_rows(turns, opts, key=key, **columns), opts, (key,))


def debug_samples(
    df: DataFrame, opts: PrepOptions = PrepOptions(), n: int = 2, key: str = "conv_id"
) -> DataFrame:
    """The first ``n`` rows by key as they would be trained on.

    Rows without an assistant are shown as well. The rows are picked before
    any text work.
    """
    first = df.orderBy(key).limit(n)
    rows = canonical.canonicalize(first, opts, (key,))
    marked = masking.loss_tokens(fit(rows, opts), opts)
    cut = marked.withColumn(
        "marked", truncation.truncate_tokens(F.col("marked"), opts, masking.end_marker())
    )
    return cut.select(
        key,
        "schema",
        F.col("report.tools_present").alias("tools_present"),
        F.col("report.extracted_think").alias("extracted_think"),
        F.col("report.unknown_roles").alias("unknown_roles"),
        "raw_length",
        "structured_length",
        F.size("marked").alias("final_length"),
        F.size(F.filter("marked", lambda t: t["in_loss"])).alias("loss_tokens"),
        F.array_join(F.col("marked.token"), "").alias("final_text"),
    )
