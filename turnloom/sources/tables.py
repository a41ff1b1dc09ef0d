"""Conversation tables as Spark sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.canonical import PROMPT_COLUMN, RESPONSE_COLUMNS


def read_conversations(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    split: str | None = None,
    schema: T.StructType | str | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Load a path (or a catalog table with ``fmt='table'``).

    ``split`` selects one partition of the ``split`` column, so only its files
    are read.
    """
    if not source:
        raise ValueError("a source path or table name is required")
    reader = spark.readStream if streaming else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.table(source) if fmt == "table" else reader.format(fmt).load(source)
    return df if split is None else df.filter(F.col("split") == split)


def read_pairs(
    df: DataFrame, prompt: str | Column, responses: dict[str, str | Column], keep: tuple[str, ...]
) -> DataFrame:
    """A flat prompt/response table under the standard column names.

    ``responses`` maps any of response, completion, answer to source columns.
    """
    unknown = set(responses) - set(RESPONSE_COLUMNS)
    if unknown or not responses:
        raise ValueError(f"responses must name some of {', '.join(RESPONSE_COLUMNS)}")

    def col(c: str | Column) -> Column:
        return F.col(c) if isinstance(c, str) else c

    return df.select(
        *keep,
        col(prompt).alias(PROMPT_COLUMN),
        *[col(c).alias(name) for name, c in responses.items()],
    )


def write_samples(df: DataFrame, path: str, shards: int | None = None, mode: str = "error") -> None:
    """Prepared samples as Parquet; ``shards`` fixes the number of files at the cost of a shuffle."""
    out = df if shards is None else df.repartition(shards)
    out.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """A report table as one file; reports have a handful of rows.

    Only the finished rows go to one task; what they are computed from stays spread out.
    """
    df.repartition(1).write.mode(mode).format(fmt).save(path)
