"""Text helpers whose results follow Python string rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Every character that counts as white space when stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space at both ends in one linear pass (no regex)."""
    return F.btrim(c, F.lit(WHITESPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def to_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Any value as text, NULL as ''. Nested values become JSON."""
    return F.coalesce(as_string(c, dtype), F.lit(""))


def as_string(c: Column, dtype: T.DataType) -> Column:
    """Like :func:`to_text` but NULL stays NULL."""
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.VariantType):
        return F.to_json(c)
    return c if isinstance(dtype, T.StringType) else c.cast("string")


def truthy_text(c: Column, dtype: T.DataType) -> Column:
    """A value as text, or NULL where it counts as false: NULL, '', zero, false, an empty list or map."""
    text = as_string(c, dtype)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, text)
    if isinstance(dtype, T.NumericType):
        return F.when(c != 0, text)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, text)
    return F.nullif(text, F.lit(""))


def first_truthy(*cols: Column) -> Column:
    """First value that is neither NULL nor '', else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))
