"""Rendered text and tokens of canonical conversations, and prompt tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import message as msg
from ..functions.barrier import with_computed
from ..functions.tokens import IM_START, THINK_CLOSE, THINK_OPEN, token_count, tokens

# Fixed value: the default system sentence of single prompts.
DEFAULT_SYSTEM = "You are a concise helpful assistant."


def message_texts(messages: Column | str = "messages", tools: Column | None = None) -> Column:
    """Rendered text per message; tool schemas belong to the first one."""
    schemas = F.col("tools") if tools is None else tools
    return F.transform(
        messages,
        lambda m, i: F.when(i == 0, msg.render_first(m, schemas)).otherwise(msg.render(m)),
    )


def render_messages(df: DataFrame) -> DataFrame:
    """Add ``rendered``: the whole conversation as one text ('' without messages)."""
    return df.withColumn("rendered", F.array_join(message_texts(), ""))


def count_tokens(df: DataFrame) -> DataFrame:
    """Add ``total_tokens`` of the rendered conversation."""
    counts = F.transform(message_texts(), token_count)
    return df.withColumn("total_tokens", F.aggregate(counts, F.lit(0), lambda a, n: a + n))


def tokenize_messages(df: DataFrame) -> DataFrame:
    """Add ``tokens`` of each message (without tool schemas) to its struct, once.

    What the tool schemas add depends on the message that comes first:
    ``tools_tokens`` as a block of their own, or ``lead`` of a system message
    that takes them in.
    """
    with_tokens = F.transform("messages", lambda m: m.withField("tokens", tokens(msg.render(m))))
    tools = F.col("tools")
    own_block = F.coalesce(token_count(msg.tools_block(tools)), F.lit(0))

    def lead(m: Column) -> Column:
        takes_in = tools.isNotNull() & (m["role"] == "system")
        return F.when(
            takes_in, token_count(msg.render_first(m, tools)) - F.size(m["tokens"])
        )

    df = with_computed(df, {"messages": with_tokens, "tools_tokens": own_block})
    return df.withColumn(
        "messages", F.transform("messages", lambda m: m.withField("lead", lead(m)))
    )


def explode_messages(df: DataFrame) -> DataFrame:
    """One row per message with its position; rows without messages stay once."""
    rest = [c for c in df.columns if c != "messages"]
    return df.select(*rest, F.posexplode_outer("messages").alias("position", "message"))


def generation_prompts(df: DataFrame, thinking: bool = True) -> DataFrame:
    """Add ``generation_prompt``: the rendered text and an open assistant turn.

    Without thinking the turn starts with an empty think block.
    """
    header = f"{IM_START}assistant\n"
    if not thinking:
        header += f"{THINK_OPEN}\n\n{THINK_CLOSE}\n\n"
    prompt = F.concat(F.array_join(message_texts(), ""), F.lit(header))
    return df.withColumn("generation_prompt", prompt)


def prompts_from_text(
    df: DataFrame, text_col: str, system: str = DEFAULT_SYSTEM, thinking: bool = True
) -> DataFrame:
    """One prompt per row: a system message, the text as user message, an open turn."""
    empty = {f: F.lit(None).cast("string") for f in ("reasoning_content", "tool_calls", "name")}

    def plain(role: str, content: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"), content.alias("content"), *[c.alias(f) for f, c in empty.items()]
        )

    chat = F.array(
        plain("system", F.lit(system)), plain("user", F.coalesce(F.col(text_col), F.lit("")))
    )
    prompts = df.withColumns({"messages": chat, "tools": F.lit(None).cast("string")})
    return generation_prompts(prompts, thinking).drop("messages", "tools")
