"""One spelling for JSON texts, as column expressions.

The text is cut into tokens. Strings are spelled anew, so that an escape and the character it
stands for are the same; numbers and the order of keys stay as they are. Objects that repeat
a key are rebuilt by a small stack machine over the tokens: the key keeps its first place and
takes the last value. Only texts with repeated keys pay for the machine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The tokens of JSON, and pairs and single halves of escaped surrogates.
_STRING = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
TOKENS = rf"{_STRING}|[{{}}\[\],:]|{_NUMBER}|true|false|null"
_BETWEEN = rf"({_STRING})|[ \t\r\n]++"
_PAIR = r"(?i)\\ud[89ab][0-9a-f]{2}\\ud[c-f][0-9a-f]{2}"
_HALF = r"(?i)\\ud[89a-f][0-9a-f]{2}"

_FRAME = "struct<object:boolean,keys:array<string>,parts:array<string>,key:string>"


def _spelled(token: Column) -> Column:
    """A string token with as few escapes as possible; halves of a surrogate pair stay escaped."""
    decoded = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")
    text = F.to_json(decoded)
    whole = ~F.rlike(F.regexp_replace(token, _PAIR, ""), F.lit(_HALF))
    escaped = F.startswith(token, F.lit('"')) & F.contains(token, F.lit("\\"))
    return F.when(escaped & whole & decoded.isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(token)


def _frame(is_object: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.struct(is_object.alias("object"), none.alias("keys"), none.alias("parts"), F.lit(None).cast("string").alias("key")).cast(_FRAME)


def _with_value(frame: Column, value: Column) -> Column:
    """The frame with one more value, or with the value of a key that it has replaced."""
    place = F.coalesce(F.array_position(frame["keys"], frame["key"]), F.lit(0))
    old = F.transform(frame["parts"], lambda p, i: F.when(i == place - 1, value).otherwise(p))
    known = frame["object"] & (place > 0)
    return F.struct(
        frame["object"].alias("object"),
        F.when(frame["object"] & (place == 0), F.concat(frame["keys"], F.array(frame["key"]))).otherwise(frame["keys"]).alias("keys"),
        F.when(known, old).otherwise(F.concat(frame["parts"], F.array(value))).alias("parts"),
        F.lit(None).cast("string").alias("key"),
    ).cast(_FRAME)


def _closed(frame: Column) -> Column:
    pairs = F.zip_with(frame["keys"], frame["parts"], lambda k, p: F.concat(k, F.lit(":"), p))
    inside = F.array_join(F.when(frame["object"], pairs).otherwise(frame["parts"]), ",")
    return F.when(frame["object"], F.concat(F.lit("{"), inside, F.lit("}"))).otherwise(F.concat(F.lit("["), inside, F.lit("]")))


def _rebuilt(token_array: Column) -> Column:
    """The text of valid JSON tokens with the last value of every repeated key."""

    def below(stack: Column, n: int) -> Column:
        return F.slice(stack, 1, F.size(stack) - n)

    def step(stack: Column, token: Column) -> Column:
        top = F.element_at(stack, -1)
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        takes_key = top["object"] & top["key"].isNull()
        named = F.struct(top["object"].alias("object"), top["keys"].alias("keys"), top["parts"].alias("parts"), token.alias("key")).cast(_FRAME)
        value = F.when(closes, _closed(top)).otherwise(token)
        receiver = F.when(closes, F.element_at(stack, -2)).otherwise(top)
        rest = below(stack, 1)
        return (
            F.when(token.isin(",", ":"), stack)
            .when(opens, F.concat(stack, F.array(_frame(token == "{"))))
            .when(~closes & takes_key, F.concat(rest, F.array(named)))
            .when(closes, F.concat(below(stack, 2), F.array(_with_value(receiver, value))))
            .otherwise(F.concat(rest, F.array(_with_value(top, token))))
        )

    start = F.array(_frame(F.lit(False)))
    return F.aggregate(token_array, start, step, lambda stack: F.element_at(F.element_at(stack, 1)["parts"], 1))


def canonical_json(text: Column) -> Column:
    """JSON text in one spelling, NULL where the text is not JSON.

    White space between tokens goes, strings have one spelling, numbers and the order of keys
    stay, and of repeated keys the first place and the last value count, at any depth.
    """
    found = F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))
    spelled = F.transform(found, _spelled)
    # The tokens make up all of the text, and they are one value: the parsers below stop after it.
    whole = F.array_join(found, "") == F.regexp_replace(text, _BETWEEN, "$1")
    whole = whole & ((F.size(found) == 1) | _closes_once(found))
    parsed = F.try_parse_json(text).isNotNull()
    # A text that does not parse may be JSON with repeated keys, which this reader allows.
    repeats = F.get_json_object(text, "$").isNotNull()
    return F.when(whole & parsed, F.array_join(spelled, "")).when(whole & repeats, _rebuilt(spelled))


def _closes_once(token_array: Column) -> Column:
    """Whether the first bracket of the tokens is their first token and its end the last."""
    marks = F.filter(token_array, lambda t: t.isin("{", "[", "}", "]"))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends"))

    def step(state: Column, mark: Column) -> Column:
        depth = state["depth"] + F.when(mark.isin("{", "["), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), (state["ends"] + (depth == 0).cast("int")).alias("ends"))

    ended = F.aggregate(marks, start, step)
    edges = F.get(token_array, F.lit(0)).isin("{", "[") & F.try_element_at(token_array, F.lit(-1)).isin("}", "]")
    return edges & (ended["ends"] == 1) & (ended["depth"] == 0)
