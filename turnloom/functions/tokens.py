"""The built-in tokenizer: a lossless regex split and stable hash ids.

Chat markers and think tags are always tokens of their own and every rendered
message ends in a marker and a newline, so the token counts of messages add up
to the count of the conversation. Truncation relies on that.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Chat markers and the split rule.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
TOKEN_PATTERN = (
    r"<\|(?:im_start|im_end|endoftext)\|>|</?think>"
    r"|[\p{L}\p{N}]+|[ \t\r\n]+|[^\p{L}\p{N} \t\r\n]"
)
EOS_TOKEN = IM_END
IGNORED_LABEL = -100


def tokens(c: Column) -> Column:
    """Tokens of a text; joined together they give the text back."""
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(c: Column) -> Column:
    return F.size(tokens(c))


def token_id(token: Column) -> Column:
    """60-bit id of one token: the first fifteen hex digits of its MD5.

    Ids of different tokens may still meet; ``token_frequencies`` reports them.
    """
    return F.conv(F.substring(F.md5(token), 1, 15), 16, 10).cast("long")


def token_ids(token_array: Column) -> Column:
    return F.transform(token_array, token_id)


def cap_tokens(c: Column, n: int | None) -> Column:
    """First ``n`` tokens of a text; no cap for NULL, zero or negative ``n``."""
    if not n or n <= 0:
        return c
    return F.array_join(F.slice(tokens(c), 1, n), "")


def attention_mask(ids: Column) -> Column:
    """One per kept token."""
    return F.array_repeat(F.lit(1), F.size(ids))
