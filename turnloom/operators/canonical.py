"""Canonical conversations from message-list or prompt/response rows.

Everything here is a narrow projection or filter: no shuffle, no Python
workers, batch and stream alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import message as msg
from ..functions.text import first_truthy, to_text, truthy_text
from ..options import PrepOptions
from .tools import normalize_tools

# The flat columns of a prompt/response row.
PROMPT_COLUMN = "prompt"
RESPONSE_COLUMNS = ("response", "completion", "answer")

_NO_MESSAGES = T.ArrayType(msg.MESSAGE_TYPE)


def _is_message_list(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType)


def _message_type(df: DataFrame, name: str) -> T.StructType | None:
    """Element type of the message list, or None if its items are no messages."""
    if not _is_message_list(df, name):
        return None
    element = df.schema[name].dataType.elementType
    return element if isinstance(element, T.StructType) else None


def _has_pairs(df: DataFrame) -> bool:
    return PROMPT_COLUMN in df.columns and any(c in df.columns for c in RESPONSE_COLUMNS)


def schema_column(df: DataFrame, opts: PrepOptions) -> Column:
    """``messages``, ``prompt_response`` or ``unknown`` per row."""
    if opts.dataset_schema != "auto":
        return F.lit(opts.dataset_schema)
    fallback = F.lit("prompt_response" if _has_pairs(df) else "unknown")
    if not _is_message_list(df, opts.messages_field):
        return fallback
    return F.when(F.col(opts.messages_field).isNotNull(), F.lit("messages")).otherwise(fallback)


def detect_schema(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Add ``schema``. Column presence is settled here, NULL lists per row."""
    return df.withColumn("schema", schema_column(df, opts))


def pairs_to_messages(df: DataFrame) -> Column:
    """User and assistant message of a prompt/response row.

    The reply is the first response column whose value does not count as false.
    """
    types = {f.name: f.dataType for f in df.schema}
    prompt = to_text(F.col(PROMPT_COLUMN), types[PROMPT_COLUMN]) if PROMPT_COLUMN in types else F.lit("")
    reply = first_truthy(
        *[truthy_text(F.col(c), types[c]) for c in RESPONSE_COLUMNS if c in types], F.lit("")
    )
    return F.array(msg.plain_message("user", prompt), msg.plain_message("assistant", reply))


def _pair_messages(df: DataFrame, opts: PrepOptions) -> Column:
    pair = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
    return F.transform(
        pairs_to_messages(df), lambda m, i: msg.as_struct(msg.from_source(m, pair, i, opts))
    )


def _list_messages(df: DataFrame, opts: PrepOptions) -> Column:
    element = _message_type(df, opts.messages_field)
    if element is None:
        return F.lit(None).cast(_NO_MESSAGES)
    items = F.transform(
        F.col(opts.messages_field),
        lambda m, i: F.when(
            m.isNotNull(), msg.as_struct(msg.from_source(m, element, i, opts))
        ),
    )
    return F.filter(items, lambda m: m.isNotNull() & ~msg.is_blank_system(m))


def clean_messages(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Replace the source columns by ``messages``: trimmed roles, text content.

    NULL items and blank system messages go; the reasoning field is settled
    (see :func:`turnloom.functions.message.from_source`). Needs ``schema``.
    """
    empty = F.array().cast(_NO_MESSAGES)
    messages = F.when(F.col("schema") == "messages", _list_messages(df, opts)).when(
        F.col("schema") == "prompt_response", _pair_messages(df, opts)
    )
    return df.withColumn("messages", F.coalesce(messages, empty))


def each_message(df: DataFrame, rule: Callable[[Column], msg.Fields]) -> DataFrame:
    """Apply a message rule to every element of ``messages``."""
    return df.withColumn(
        "messages", F.transform("messages", lambda m: msg.with_fields(m, rule(m)))
    )


def extract_think(df: DataFrame) -> DataFrame:
    """Move the first closed think block of each assistant message into its reasoning."""
    df = each_message(each_message(df, msg.think_block), msg.cut_think_block)
    return df.withColumn(
        "messages", F.transform("messages", lambda m: m.dropFields("open", "close"))
    )


def apply_think_policy(df: DataFrame, opts: PrepOptions) -> DataFrame:
    """Drop or cap reasoning; ``dropped_think`` counts removed think messages."""
    if not opts.drops_thinking:
        capped = each_message(df, lambda m: msg.think_policy(m, opts)) if opts.token_cap else df
        return capped.withColumn("dropped_think", F.lit(0))
    kept = F.filter("messages", lambda m: ~msg.is_dropped_think(m, opts))
    return each_message(
        df.withColumn("dropped_think", F.size("messages") - F.size(kept)).withColumn(
            "messages", kept
        ),
        lambda m: msg.think_policy(m, opts),
    )


def unknown_roles(opts: PrepOptions) -> Column:
    """Roles outside the template's set, each once, in order of appearance."""
    roles = F.transform("messages", lambda m: m["role"])
    return F.array_distinct(F.filter(roles, lambda r: msg.is_unknown_role(r, opts)))


def _count(field: str) -> Column:
    return F.aggregate("messages", F.lit(0), lambda n, m: n + m[field])


def parse_report(df: DataFrame, opts: PrepOptions) -> DataFrame:
    """Add ``report``: what canonicalisation did to the row."""
    return df.withColumn(
        "report",
        F.struct(
            _count("extracted").alias("extracted_think"),
            _count("moved").alias("moved_reasoning"),
            F.col("dropped_think"),
            F.col("tools").isNotNull().alias("tools_present"),
            F.col("tools_from_string"),
            unknown_roles(opts).alias("unknown_roles"),
        ),
    )


def usable_rows(df: DataFrame, opts: PrepOptions) -> DataFrame:
    """Source rows that will keep a message, of a loss-bearing role if one is demanded.

    Gives the rows that :func:`drop_without_assistant` and dropping empty
    conversations would leave after canonicalisation. But it reads only roles
    (and blank system contents), so the costly columns are computed for
    surviving rows only and never twice.
    """
    roles = set(opts.loss_roles)

    def survives(m: msg.Message) -> Column:
        kept = ~msg.is_blank_system(m) & ~msg.is_dropped_think(m, opts)
        return kept & m["role"].isin(*roles) if opts.drop_if_no_assistant else kept

    element = _message_type(df, opts.messages_field)
    in_list = F.lit(False)
    if element is not None:
        in_list = F.exists(
            opts.messages_field,
            lambda m: m.isNotNull() & survives(msg.from_source(m, element, F.lit(0), opts)),
        )
    pair = {"user", "assistant"} - ({opts.think_role} if opts.drops_thinking else set())
    in_pair = bool(pair & roles if opts.drop_if_no_assistant else pair)
    schema = schema_column(df, opts)
    return df.filter(
        F.when(schema == "messages", F.coalesce(in_list, F.lit(False)))
        .when(schema == "prompt_response", in_pair)
        .otherwise(False)
    )


def canonicalize(
    df: DataFrame, opts: PrepOptions = PrepOptions(), keep: tuple[str, ...] = ("conv_id",)
) -> DataFrame:
    """``keep`` columns plus ``schema``, ``tools``, ``messages`` and ``report``."""
    df = clean_messages(normalize_tools(detect_schema(df, opts)), opts)
    df = df.select(*keep, "schema", "tools", "tools_from_string", "messages")
    if opts.extract_think_tags:
        df = extract_think(df)
    df = parse_report(apply_think_policy(df, opts), opts)
    return df.select(*keep, "schema", "tools", "messages", "report")


def drop_without_assistant(df: DataFrame, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Keep canonical rows that hold a message of a loss-bearing role."""
    if not opts.drop_if_no_assistant:
        return df
    roles = opts.loss_roles
    return df.filter(F.exists("messages", lambda m: m["role"].isin(roles)))


def parse_report_summary(df: DataFrame) -> DataFrame:
    """Report totals per schema."""
    r = F.col("report")
    return df.groupBy("schema").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(r["extracted_think"]).alias("extracted_think"),
        F.sum(r["moved_reasoning"]).alias("moved_reasoning"),
        F.sum(r["dropped_think"]).alias("dropped_think"),
        F.count_if(r["tools_present"]).alias("tools_present"),
        F.count_if(r["tools_from_string"]).alias("tools_from_string"),
        F.avg(r["tools_present"].cast("double")).alias("tools_share"),
    )


def unknown_role_counts(df: DataFrame) -> DataFrame:
    """Conversations per unknown role and schema."""
    return (
        df.select("schema", F.explode("report.unknown_roles").alias("role"))
        .groupBy("schema", "role")
        .agg(F.count(F.lit(1)).alias("n_conversations"))
    )
