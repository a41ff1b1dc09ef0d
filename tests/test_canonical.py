"""Edge rows of the canonical form."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from turnloom import PrepOptions
from turnloom.functions.json_text import canonical_json
from turnloom.functions.text import strip
from turnloom.functions.tokens import tokens
from turnloom.operators import canonical, rendering
from turnloom.operators.tools import normalize_tools
from turnloom.plans.prepare import debug_samples

FULL = "conv_id long, messages array<struct<role string, content string, reasoning_content string, thinking string>>"


def messages_of(spark, messages, schema=FULL, **settings):
    df = spark.createDataFrame([(1, messages)], schema)
    row = canonical.canonicalize(df, PrepOptions(**settings)).first()
    return [(m.role, m.content, m.reasoning_content) for m in row.messages], row.report


def test_strip_equals_python(spark):
    texts = [" a \n", " x\x1f", "", "　 \t", "mid dle", "\x85y\xa0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(strip(F.col("t"))).collect()
    assert [r[0] for r in rows] == [t.strip() for t in texts]


def test_tokens_join_to_the_text(spark):
    text = "<|im_start|>user\nÉté 12 <think>a</think> !!<|im_end|>\n"
    found = spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t"))).first()[0]
    assert "".join(found) == text
    assert found[0] == "<|im_start|>" and "<think>" in found and found[-2:] == ["<|im_end|>", "\n"]


def test_roles_are_trimmed_and_blank_system_goes(spark):
    rows = [("user", "q", None, None), (" system\n", " \t", None, None), None, (" assistant ", None, None, None)]
    found, _ = messages_of(spark, rows)
    assert found == [("user", "q", None), ("assistant", "", None)]


def test_reasoning_moves_for_every_role(spark):
    rows = [("user", "q", None, " x "), ("assistant", "a", " ", "y"), ("assistant", "a", "kept ", "z")]
    found, report = messages_of(spark, rows)
    assert [r for _, _, r in found] == ["x", "y", "kept "]
    assert report.moved_reasoning == 2


@pytest.mark.parametrize(
    ("content", "reasoning", "want"),
    [
        ("<think>a</think>b<think>c</think>", None, ("b<think>c</think>", "a", 1)),
        ("<think>\n a \n</think>\n\n b ", None, ("b ", "a", 1)),
        ("x <think>n</think> y", "old", ("x y", "old", 1)),
        ("<think></think>z", None, ("z", "", 1)),
        ("<think> open", None, ("<think> open", None, 0)),
        ("</think>x<think>", None, ("</think>x<think>", None, 0)),
        ("a</think><think>b</think>c", None, ("a</think>c", "b", 1)),
        ("<think><think>a</think>b", None, ("b", "<think>a", 1)),
        ("$1 <think>\\$2</think> $0", None, ("$1 $0", "\\$2", 1)),
    ],
)
def test_think_blocks(spark, content, reasoning, want):
    found, report = messages_of(spark, [("assistant", content, reasoning, None)])
    assert (*found[0][1:], report.extracted_think) == want


def test_think_blocks_of_other_roles_stay(spark):
    found, report = messages_of(spark, [("user", "<think>a</think>b", None, None)])
    assert found == [("user", "<think>a</think>b", None)] and report.extracted_think == 0


def test_drop_mode_clears_reasoning_and_think_turns(spark):
    rows = [("think", "t", None, None), ("assistant", "a", "r", None), ("user", "u", None, None)]
    found, report = messages_of(spark, rows, think_mode="drop")
    assert found == [("assistant", "a", ""), ("user", "u", None)]
    assert report.dropped_think == 1


def test_cap_keeps_the_first_tokens(spark):
    rows = [("think", "ab cd ef", None, None), ("assistant", "x y z", "ab cd", None)]
    found, _ = messages_of(spark, rows, think_max_tokens=2)
    assert found == [("think", "ab ", None), ("assistant", "x y z", "ab ")]


def test_unknown_roles_in_order_once(spark):
    rows = [(r, "x", None, None) for r in ("fn", "user", "bot", "fn", "think", "tool")]
    _, report = messages_of(spark, rows)
    assert report.unknown_roles == ["fn", "bot"]


def test_null_list_falls_back_to_pairs_and_empty_response_falls_through(spark):
    schema = "conv_id long, messages array<struct<role string, content string>>, prompt string, response string, completion string, answer string"
    data = [(1, None, "p", "", None, "a"), (2, [("user", "q")], "p", "r", None, None)]
    rows = canonical.canonicalize(spark.createDataFrame(data, schema)).orderBy("conv_id").collect()
    assert [r.schema for r in rows] == ["prompt_response", "messages"]
    assert [(m.role, m.content) for m in rows[0].messages] == [("user", "p"), ("assistant", "a")]
    forced = PrepOptions(dataset_schema="messages", drop_if_no_assistant=False)
    df = spark.createDataFrame(data, schema)
    assert canonical.canonicalize(df, forced).filter("size(messages) = 0").count() == 1
    assert canonical.usable_rows(df, forced).count() == 1


def test_unknown_schema_has_no_messages(spark):
    df = spark.createDataFrame([(1, "x")], "conv_id long, text string")
    row = canonical.canonicalize(df).first()
    assert row.schema == "unknown" and row.messages == []
    assert canonical.usable_rows(df, PrepOptions()).count() == 0


@pytest.mark.parametrize(
    ("value", "text", "parsed"),
    [
        (None, None, False),
        ("  ", None, False),
        ("[]", "[]", True),
        (' {"a": 1} ', '{"a":1}', True),
        ('{ "a" : [ 1 , "x  \\" y" ] }', '{"a":[1,"x  \\" y"]}', True),
        ("null", None, False),
        ("bad{ ", "bad{ ", False),
    ],
)
def test_tools_text(spark, value, text, parsed):
    df = spark.createDataFrame([(value, "[1]")], "tools string, functions string")
    row = normalize_tools(df).first()
    assert (row.tools, row.tools_from_string) == (text, parsed)


def test_typed_tools_become_json(spark):
    df = spark.createDataFrame([([("f", None)],)], "functions array<struct<name string, doc string>>")
    row = normalize_tools(df).first()
    assert (row.tools, row.tools_from_string) == ('[{"name":"f","doc":null}]', False)


def test_usable_rows_equal_filtering_afterwards(spark):
    data = [
        (1, [("user", "a")]),
        (2, [("user", "a"), (" assistant", "b")]),
        (3, [("system", " "), None]),
        (4, [("think", "x")]),
        (5, None),
    ]
    df = spark.createDataFrame(data, "conv_id long, messages array<struct<role string, content string>>")
    for settings in ({}, {"assistant_roles": ("think",)}, {"assistant_roles": ("think",), "think_mode": "drop"},
                     {"drop_if_no_assistant": False}, {"assistant_roles": ("system",)}):
        opts = PrepOptions(**settings)
        after = canonical.drop_without_assistant(canonical.canonicalize(df, opts), opts)
        want = {r.conv_id for r in after.filter("size(messages) > 0").collect()}
        assert {r.conv_id for r in canonical.usable_rows(df, opts).collect()} == want


def test_settings_are_validated():
    for bad in ({"think_loss": "none"}, {"truncate_side": "middle"}):
        with pytest.raises(ValueError):
            PrepOptions(**bad)
    assert PrepOptions(think_mode="anything").drops_thinking is False
    assert PrepOptions(max_length=None).limit == 0


def test_prompts_and_explode(spark):
    df = spark.createDataFrame([(1, "hi")], "conv_id long, text string")
    prompt = rendering.prompts_from_text(df, "text", system="S").first().generation_prompt
    assert prompt == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    )
    empty = canonical.canonicalize(df)
    assert rendering.render_messages(empty).first().rendered == ""
    assert rendering.explode_messages(empty).first().position is None


def test_tool_calls_stand_before_the_end_marker(spark):
    schema = "conv_id long, messages array<struct<role string, content string, tool_calls string>>"
    df = spark.createDataFrame([(1, [("assistant", "a", '[{"id":1}]'), ("user", "b", None)])], schema)
    assert rendering.render_messages(canonical.canonicalize(df)).first().rendered == (
        '<|im_start|>assistant\na\n<tool_call>\n[{"id":1}]\n</tool_call><|im_end|>\n<|im_start|>user\nb<|im_end|>\n'
    )


def test_replies_that_count_as_false_fall_through(spark):
    rows = [(1, 0, False, "x"), (2, 5, False, "x"), (3, None, True, "x"), (4, None, None, None)]
    df = spark.createDataFrame(rows, "prompt long, response long, completion boolean, answer string")
    flat = canonical.canonicalize(df, keep=("prompt",)).orderBy("prompt").collect()
    assert [r.messages[1].content for r in flat] == ["x", "5", "true", ""]


def test_debug_counts_nothing_for_rows_without_messages(spark):
    df = spark.createDataFrame([(1, [], "[]")], FULL + ", tools string")
    row = debug_samples(df, PrepOptions(max_length=40)).first()
    assert (row.raw_length, row.structured_length, row.final_length, row.final_text) == (0, 0, 0, "")


def test_reasoning_field_falls_back_when_empty(spark):
    found, _ = messages_of(spark, [("assistant", "a", None, " t ")], reasoning_field="")
    assert found == [("assistant", "a", "t")]


def random_json(rnd, depth=0):
    """A JSON text with repeated keys, needless escapes and white space."""
    gap = lambda: rnd.choice(["", "", " ", "\n\t"])
    kind = rnd.random()
    if depth > 3 or kind < 0.35:
        return rnd.choice(["1", "-2.50", "1e5", "true", "null", '"x"', '"\\u00e9"', '"é"', '"a  b"', '""', '"\\\\"', '"}{,:"', '"\\ud83d\\ude00"'])
    parts = [random_json(rnd, depth + 1) for _ in range(rnd.randrange(5))]
    if kind < 0.6:
        return f"[{gap()}{(gap() + ',' + gap()).join(parts)}{gap()}]"
    keys = [rnd.choice(['"a"', '"b"', '"\\u0061"', '"é"', '"\\u00e9"']) for _ in parts]
    return f"{{{gap()}{(',' + gap()).join(f'{k}{gap()}:{gap()}{p}' for k, p in zip(keys, parts))}{gap()}}}"


class Number(str):
    pass


def plain_json(text):
    """What `json.loads` reads, numbers as they are written; None where it fails."""

    def dump(value):
        if isinstance(value, Number):
            return str(value)
        if isinstance(value, dict):
            return "{" + ",".join(f"{dump(k)}:{dump(v)}" for k, v in value.items()) + "}"
        if isinstance(value, list):
            return "[" + ",".join(map(dump, value)) + "]"
        return json.dumps(value, ensure_ascii=False)

    def refuse(_):
        raise ValueError("not JSON")

    try:
        return dump(json.loads(text, parse_float=Number, parse_int=Number, parse_constant=refuse))
    except ValueError:
        return None


def test_one_spelling_of_json(spark):
    rnd = random.Random(6)
    texts = [random_json(rnd) for _ in range(300)]
    texts += [t[: rnd.randrange(len(t))] + rnd.choice(["", "}", "]", ",", "x", '"', " 1"]) for t in texts[:100]]
    texts += ['{"a":1} x', '{"a":1,"a":2}{}', '{"a":1,"a":2,}', "{'a':1,'a':2}", '{"a":1,"a":01}', '{"a":1,"a":NaN}', '{"a" 1,"a":2}', '"x" {"a":1,"a":2}', "[1,,2]", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", canonical_json(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == {t: plain_json(t) for t in texts}


def test_equal_schemas_give_equal_tokens(spark):
    rows = [('[{"name":"x","name":"caf\\u00e9"}]',), ('[ {"name" : "café"} ]',)]
    found = normalize_tools(spark.createDataFrame(rows, "tools string")).select("tools", "tools_from_string").distinct().collect()
    assert [tuple(r) for r in found] == [('[{"name":"café"}]', True)]


def test_long_json_needs_no_deep_stack(spark):
    texts = ['{"a":"' + "x\\n" * 60_000 + '","a":1}', '{"a":"' + "y" * 1_000_000 + '"}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.length(canonical_json(F.col("t"))).alias("n")).collect()
    assert [r.n for r in rows] == [7, 1_000_008]
