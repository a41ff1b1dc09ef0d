"""Running sums, history prompts and turn-grain truncation on sparse, huge and random conversations."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import brute
from test_truncation import turn_table
from turnloom import PrepOptions
from turnloom.operators import history, turn_truncation
from turnloom.plans import prepare
from turnloom.sources import turns as turn_ops

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("orders", ["dense", "microseconds", "bursts", "wide"])
def test_sums_and_parts_with_any_order_values(spark, orders):
    rnd = random.Random(orders)
    values = {
        "dense": list(range(3000)),
        "microseconds": [1_700_000_000_000_000 + 977_131 * i + rnd.randrange(900_000) for i in range(3000)],
        "bursts": [10**15 * (i // 500) + i for i in range(3000)],
        "wide": sorted({rnd.randrange(-(2**62), 2**62) for _ in range(3000)}),
    }[orders]
    rows = [(k, v, "user", "x" * (i % 7)) for k in (1, None) for i, v in enumerate(values)] + [(2, values[5], "user", "ab")]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected, total = {}, {}
    for k, v, _, text in rows:
        expected[k, v] = total.get(k, 0)
        total[k] = expected[k, v] + len(text)
    for block, branch in ((1 << 16, 1 << 24), (64, 4)):
        summed = turn_ops.running_totals(turns, "conv_id", "turn", {"before": F.length("text"), "rank": F.lit(1)}, block, branch).collect()
        assert {(r["conv_id"], r["turn"]): r["before"] for r in summed} == expected
        assert sorted(r["rank"] for r in summed if r["conv_id"] == 1) == list(range(3000))
    parts = turn_ops.assemble_conversations(turns, max_turns=1024).collect()
    assert sorted((r["conv_id"] or 0, r["part"], len(r["messages"])) for r in parts) == [
        (0, 0, 1024), (0, 1, 1024), (0, 2, 952), (1, 0, 1024), (1, 1, 1024), (1, 2, 952), (2, 0, 1)
    ]


def test_no_window_spans_more_than_a_branch(spark):
    """The rows that windows of the upper levels see, with microsecond values."""
    turns = spark.range(4000).select(F.lit(1).alias("conv_id"), (F.col("id") * 1_000_003).alias("turn"))
    plan = turn_ops.running_total(turns, "conv_id", "turn", F.lit(1), "rank")._jdf.queryExecution().optimizedPlan().toString()
    spans = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert len(spans) == 3
    assert sum("_branch" in line or "_block" in line for line in spans) == 3


def plain_prompts(rows, budget):
    """{(conversation, turn): (first turn, turns, tokens, prompt)} by trying every start."""
    out, talks = {}, {}
    for conv, turn, role, text in sorted(rows):
        text = text.strip() if role in ("user", "assistant") else text
        if (role == "user" and not text) or (role == "system" and not text.strip()):
            continue
        talks.setdefault(conv, []).append((turn, role, f"<|im_start|>{role}\n{text}<|im_end|>\n"))
    count = lambda text: len(brute.encode(text)[0])
    for conv, turns in talks.items():
        own = turns[0][1] == "system"
        head = turns[0][2] if own else history.DEFAULT_HEAD
        turns = turns[1:] if own else turns
        sizes = [count(t[2]) for t in turns]
        for i, (turn, role, _) in enumerate(turns):
            if role != "user":
                continue
            fixed = count(head) + 3
            start = next(s for s in range(i + 1) if s == i or sum(sizes[s : i + 1]) + fixed <= budget)
            text = "".join(t[2] for t in turns[start : i + 1])
            out[conv, turn] = (turns[start][0], i - start + 1, sum(sizes[start : i + 1]) + fixed, head + text + "<|im_start|>assistant\n")
    return out


@pytest.mark.parametrize("budget", [1, 40, 90, 400, 10**6])
def test_history_prompts_equal_trying_every_start(spark, budget):
    rnd = random.Random(budget)
    rows = []
    for conv in range(25):
        opening = rnd.choice(["system", "user", "assistant"])
        for i in range(rnd.choice([1, 2, 9, 30])):
            role = opening if i == 0 else rnd.choice(["user", "assistant", "system", "tool"])
            text = rnd.choice(["", "  ", " hi there \n", "w " * rnd.randrange(60), "some, more. words"])
            rows.append((conv, i * rnd.choice([1, 1000]) + 10**6 * i, role, text))
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {(r[0], r[1]): tuple(r)[2:] for r in history.history_prompts(turns, budget).collect()}
    assert got == plain_prompts(rows, budget)


def test_history_of_a_huge_conversation_is_linear(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"word{i} " * (i % 5 + 1)) for i in range(5200)]
    turns = spark.createDataFrame(rows, SCHEMA)
    kept = history.history_turns(turns)
    index = history.history_index(kept, 100).collect()
    assert len(index) == 2600 and all(r["n_tokens"] <= 100 for r in index)
    prompts = history.history_prompts(turns, 100)
    assert prompts.agg(F.count("*"), F.max("n_turns") < 20, F.sum(F.length("prompt")) < 2600 * 1000).first() == (2600, True, True)
    assert history.history_prompts(turns.limit(0), 100).collect() == []
    with pytest.raises(ValueError):
        history.history_index(kept, 0)


def test_turn_grain_equals_the_plain_rule(spark):
    """Kept turns, reasoning and texts of random conversations, with tools and without assistants."""
    rows = brute.random_conversations(random.Random(8), 120)
    for limit in (0, 30, 60, 120, 4000):
        opts = PrepOptions(max_length=limit, extract_think_tags=False)
        kept = prepare.fitted_turns(turn_table(spark, rows), opts, text="content").collect()
        got = {}
        for r in sorted(kept, key=lambda r: (r.conv_id, r.pos)):
            got.setdefault(r.conv_id, []).append(r.rendered)
        expected = {}
        for key, messages, tools in rows:
            if any(m["role"] == "assistant" for m in messages):
                fitted = brute.fit(messages, limit, tools) if limit else messages
                expected[key] = brute.render(fitted, tools)
        assert {k: "".join(v) for k, v in got.items()} == expected


def test_turn_grain_gathers_no_conversation(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    plan = turn_truncation.cut_turns(turns, PrepOptions(max_length=50))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan
