"""Length and loss statistics as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.tokens import IGNORED_LABEL, token_id

# Reported percentiles and the width of the share bar.
PERCENTILES = (25, 50, 75, 90, 95, 99)
BAR_WIDTH = 20
# Leading bits of a length that name its band.
BAND_BITS = 7


def sample_stats(samples: DataFrame, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Tokens, tokens in loss, and whether any cut fired, per sample."""
    total = F.size("input_ids")
    return samples.select(
        *keep,
        total.alias("total_tokens"),
        F.size(F.filter("labels", lambda x: x != IGNORED_LABEL)).alias("loss_tokens"),
        (total < F.col("raw_length")).alias("was_truncated"),
    )


def length_histogram(lengths: DataFrame, column: str = "final_length") -> DataFrame:
    """Samples per length. Everything below reads this table, never the samples again."""
    return lengths.groupBy(F.col(column).alias("length")).agg(
        F.count(F.lit(1)).alias("n_samples")
    )


def raw_lengths(
    lengths: DataFrame, original: str = "structured_length", final: str = "final_length"
) -> DataFrame:
    """Largest length before the token cut, falling back to the final one."""
    source = original if original in lengths.columns else final
    return lengths.agg(
        F.max(source).cast("long").alias("dataset_max"),
        F.max(final).cast("long").alias("final_max"),
        F.count(F.lit(1)).alias("n_samples"),
    ).filter(F.col("n_samples") > 0)


def length_percentiles(histogram: DataFrame, max_length: int | None = 0) -> DataFrame:
    """p25 to p99 and the maximum: the element at ``int(p / 100 * (n - 1))`` in length order.

    ``at_max`` flags percentiles that reach ``max_length``. Lengths fall into bands
    that widen with the length. Only the bands, at most some thousand whatever the
    table, are put in order in one place; the running count goes on inside each band.
    """
    length = F.col("length").cast("long")
    spare = F.greatest(F.length(F.bin(length)) - BAND_BITS, F.lit(0))
    banded = histogram.withColumn("band", (spare * 2**BAND_BITS + F.call_function("shiftright", length, spare)))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = banded.groupBy("band").agg(F.sum("n_samples").alias("in_band"))
    starts = bands.select(
        "band",
        F.coalesce(F.sum("in_band").over(before), F.lit(0)).alias("start"),
        F.sum("in_band").over(Window.partitionBy()).alias("n"),
    )
    inside = Window.partitionBy("band").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    counted = banded.join(starts, "band").withColumn("upto", F.col("start") + F.sum("n_samples").over(inside))

    def at(p: int) -> Column:
        index = F.floor(F.lit(p / 100.0) * (F.col("n") - 1))
        return F.min(F.when(F.col("upto") > index, F.col("length"))).cast("long")

    one_row = counted.agg(
        *[at(p).alias(f"p{p}") for p in PERCENTILES],
        F.max("length").cast("long").alias("max"),
        F.max("n").alias("n"),
    ).filter(F.col("n") > 0)
    names = [f"p{p}" for p in PERCENTILES] + ["max"]
    rows = F.explode(
        F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("length")) for c in names])
    )
    limit = max_length or 0
    reaches = (F.col("length") >= limit) & (F.col("label") != "max") if limit else F.lit(False)
    return (
        one_row.select(rows.alias("r"))
        .select("r.label", "r.length")
        .withColumn("at_max", reaches)
    )


def _share_bar(ratio: Column) -> Column:
    filled = F.bround(ratio * BAR_WIDTH, 0).cast("int")
    return F.concat(
        F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(BAR_WIDTH) - filled)
    )


def window_utilisation(histogram: DataFrame, max_length: int) -> DataFrame:
    """Samples per share of the window.

    Both ends of a bucket are inclusive, so a length on a border counts twice,
    and one between ``max_length - 1`` and ``max_length`` does not exist.
    """
    top = float(max_length)
    # Bucket names and bounds.
    buckets = [
        ("< 25%", 0.0, top * 0.25),
        ("25-50%", top * 0.25, top * 0.50),
        ("50-75%", top * 0.50, top * 0.75),
        ("75-99%", top * 0.75, top - 1),
        ("at max", top, float("inf")),
    ]
    length, n = F.col("length"), F.col("n_samples")
    counts = histogram.agg(
        F.sum("n_samples").alias("n"),
        *[
            F.sum(F.when(length.between(lo, hi), n).otherwise(0)).alias(name)
            for name, lo, hi in buckets
        ],
    ).filter(F.col("n") > 0)
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("bucket"), F.col(f"`{name}`").alias("n_samples"))
            for name, _, _ in buckets
        ]
    )
    ratio = F.col("n_samples").cast("double") / F.col("n")
    return (
        counts.select("n", F.explode(rows).alias("r"))
        .select("n", "r.bucket", "r.n_samples")
        .withColumn("ratio", ratio)
        .withColumn("bar", _share_bar(F.col("ratio")))
        .select("bucket", "n_samples", "ratio", "bar")
    )


def truncation_summary(histogram: DataFrame, max_length: int) -> DataFrame:
    """Samples that reach ``max_length`` (cut or exactly that long) and the others."""
    reaches = F.when(F.col("length") >= max_length, F.col("n_samples")).otherwise(0)
    n = F.col("n").cast("double")
    return (
        histogram.agg(F.sum("n_samples").alias("n"), F.sum(reaches).alias("truncated"))
        .filter(F.col("n") > 0)
        .withColumn("not_truncated", F.col("n") - F.col("truncated"))
        .withColumn("truncated_share", F.col("truncated") / n)
        .withColumn("not_truncated_share", F.col("not_truncated") / n)
    )


def length_advice(histogram: DataFrame, max_length: int) -> DataFrame:
    """One row: shares of samples at ``max_length`` and below a quarter of it, and what to do."""
    shares = window_utilisation(histogram, max_length).agg(
        F.max(F.when(F.col("bucket") == "at max", F.col("ratio"))).alias("at_max_share"),
        F.max(F.when(F.col("bucket") == "< 25%", F.col("ratio"))).alias("short_share"),
    )
    # Shares above which advice is given.
    advice = (
        F.when(F.col("at_max_share") > 0.30, "raise max_length or filter long samples")
        .when(F.col("short_share") > 0.50, "lower max_length")
        .otherwise("keep max_length")
    )
    return shares.filter(F.col("at_max_share").isNotNull()).withColumn("advice", advice)


def role_totals(marked: DataFrame) -> DataFrame:
    """Tokens and loss tokens by role, from turns with ``role``, ``n_tokens``, ``n_loss``."""
    return marked.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("n_tokens").cast("long").alias("tokens"),
        F.sum("n_loss").cast("long").alias("loss_tokens"),
    )


def tools_overhead(costs: DataFrame, max_length: int) -> DataFrame:
    """What tool schemas add, by whether a conversation has any.

    Takes ``total_tokens`` with the schemas and ``tools_cost`` of each conversation.
    """
    reaches = F.when(F.col("total_tokens") >= max_length, 1.0).otherwise(0.0)
    return costs.groupBy((F.col("tools_cost") > 0).alias("tools_present")).agg(
        F.count(F.lit(1)).alias("n_conversations"),
        F.sum("tools_cost").cast("long").alias("added_tokens"),
        F.avg("tools_cost").alias("mean_added"),
        F.max("tools_cost").cast("long").alias("max_added"),
        F.avg(reaches).alias("at_max_share"),
    )


def token_frequencies(listed: DataFrame) -> DataFrame:
    """Count, id and ``n_same_id`` of each token: the tokens that share its id, itself included."""
    counted = listed.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("token_id", token_id(F.col("token")))
    same = Window.partitionBy("token_id")
    return counted.withColumn("n_same_id", F.count(F.lit(1)).over(same))


def histogram_report(histogram: DataFrame, max_length: int | None = 0) -> dict[str, DataFrame]:
    """The length tables that a histogram gives; the window tables need a ``max_length``."""
    report = {"histogram": histogram, "percentiles": length_percentiles(histogram, max_length)}
    if max_length:
        report["utilisation"] = window_utilisation(histogram, max_length)
        report["truncation"] = truncation_summary(histogram, max_length)
    return report


def length_report(lengths: DataFrame, max_length: int | None = 0) -> dict[str, DataFrame]:
    """All length tables by name; the window tables need a ``max_length``."""
    return {**histogram_report(length_histogram(lengths), max_length), "raw_lengths": raw_lengths(lengths)}
