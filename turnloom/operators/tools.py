"""Tool-schema columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.barrier import with_computed
from ..functions.json_text import canonical_json
from ..functions.text import as_string, strip

# Column names searched, in order.
TOOL_COLUMNS = ("tools", "tool_schemas", "functions", "function_schemas")


def resolve_tools_column(df: DataFrame) -> str | None:
    """First tools column that exists; a NULL in it still hides the later ones."""
    return next((c for c in TOOL_COLUMNS if c in df.columns), None)


def parse_tools(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """``(tools text or NULL, was it parsed from a string)`` for one column.

    Valid JSON text gets one spelling, so equal schemas are equal texts: no white space between
    tokens, no needless escapes, and of repeated keys the first place and the last value. The
    order of keys and the spelling of numbers stay. Text that does not parse is kept untouched.
    JSON ``null`` and blank text count as absent.
    """
    if not isinstance(dtype, T.StringType):
        return as_string(c, dtype), F.lit(False)
    trimmed = F.nullif(strip(c), F.lit(""))
    spelled = canonical_json(trimmed)
    text = F.when(spelled.isNull() & trimmed.isNotNull(), c).when(spelled != "null", spelled)
    return text, F.coalesce(spelled != "null", F.lit(False))


def normalize_tools(df: DataFrame) -> DataFrame:
    """Set ``tools`` and ``tools_from_string`` from whichever tools column exists."""
    name = resolve_tools_column(df)
    if name is None:
        text, parsed = F.lit(None).cast("string"), F.lit(False)
    else:
        text, parsed = parse_tools(F.col(name), df.schema[name].dataType)
    return with_computed(df, {"tools_from_string": parsed, "tools": text})
