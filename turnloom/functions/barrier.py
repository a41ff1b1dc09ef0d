"""Keep costly columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, but the columns come out of a one-row generator.

    Spark copies a column's expression into filters that it pushes down and into
    other columns, which repeats the work and can make long chains explode. It does
    not copy what a generator gives, and filters on other columns, such as
    keys, still move below it.
    """
    rest = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*rest, F.inline(F.array(row))).select(*df.columns, *[c for c in columns if c not in df.columns])
