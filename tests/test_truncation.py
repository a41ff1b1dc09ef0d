"""Fitting and labels against a plain statement of the rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from turnloom import PrepOptions
from turnloom.plans.external import prepare_samples_with
from turnloom.functions.external_tokenizer import ExternalTokenizer
from turnloom.functions.joined_counts import JoinedCounts
from turnloom.operators import rendering, truncation
from turnloom.plans import prepare
from turnloom.sources import turns as turn_ops

LIST_SCHEMA = (
    "conv_id long, messages array<struct<role string, content string, reasoning_content string>>,"
    " tools string"
)
TURN_SCHEMA = (
    "conv_id long, turn long, role string, content string, reasoning_content string, tools string"
)
SETTINGS = [
    {"max_length": 60, "think_loss": "all"},
    {"max_length": 60, "think_loss": "answer_only", "truncate_side": "right"},
    {"max_length": 35, "think_loss": "answer_plus_think"},
    {"max_length": 0, "think_loss": "answer_only"},
    {"max_length": 25, "truncate_side": "right", "assistant_roles": ("tool", "assistant")},
]


def list_table(spark, rows):
    data = [
        (key, [(m["role"], m["content"], m["reasoning"]) for m in messages], tools)
        for key, messages, tools in rows
    ]
    return spark.createDataFrame(data, LIST_SCHEMA)


def turn_table(spark, rows):
    data = [
        (key, turn, m["role"], m["content"], m["reasoning"], tools)
        for key, messages, tools in rows
        for turn, m in enumerate(messages)
    ]
    return spark.createDataFrame(data, TURN_SCHEMA)


def expected(rows, settings, enc=brute.encode, eos=brute.EOS):
    roles = settings.get("assistant_roles") or ("assistant",)
    return {
        key: brute.sample(
            messages,
            settings["max_length"],
            tools,
            settings.get("think_loss", "all"),
            settings.get("truncate_side", "left"),
            roles,
            enc,
            eos,
        )
        for key, messages, tools in rows
        if any(m["role"] in roles for m in messages)
    }


def collected(df):
    return {
        r.conv_id: {
            "input_ids": r.input_ids,
            "labels": r.labels,
            "original_length": r.original_length,
            "raw_length": r.raw_length,
        }
        for r in df.collect()
    }


@pytest.mark.parametrize("settings", SETTINGS)
def test_message_lists_match_the_rules(spark, settings):
    rows = brute.random_conversations(random.Random(11), 300)
    opts = PrepOptions(extract_think_tags=False, **settings)
    actual = collected(prepare.prepare_samples(list_table(spark, rows), opts))
    assert actual == expected(rows, settings)


@pytest.mark.parametrize("settings", [SETTINGS[1], SETTINGS[2], SETTINGS[4]])
@pytest.mark.parametrize("salts", [1, 3])
def test_turn_tables_match_the_rules(spark, settings, salts, monkeypatch):
    """Conversations longer than what can reach a sample, in few and in more sub-groups."""
    rows = brute.random_conversations(random.Random(5), 60, max_turns=70, words=4)
    opts = PrepOptions(extract_think_tags=False, **settings)
    monkeypatch.setattr(turn_ops, "SALTS", salts)
    df = prepare.prepare_turn_samples(turn_table(spark, rows), opts, text="content")
    assert collected(df) == expected(rows, settings)


def test_turns_without_an_assistant_are_cut_only(spark):
    rows = [(1, [{"role": "user", "content": f"w{i} x", "reasoning": None} for i in range(800)], None)]
    for side in ("left", "right"):
        opts = PrepOptions(max_length=30, truncate_side=side, drop_if_no_assistant=False)
        df = prepare.prepare_turn_samples(turn_table(spark, rows), opts, text="content")
        assert collected(df) == {1: brute.sample(rows[0][1], 30, side=side)}


def huge(n, trailing):
    """One conversation of n turns with reasoning, `trailing` of them after the last assistant."""
    roles = ["system"] + ["user", "assistant"] * ((n - trailing) // 2)
    roles += ["user"] * (n - len(roles))
    return [
        {"role": r, "content": f"c{i} .", "reasoning": "t " * (i % 40) if r == "assistant" else None}
        for i, r in enumerate(roles)
    ]


@pytest.mark.parametrize("trailing", [3, 300])
def test_one_rule_for_conversations_of_any_size(spark, trailing):
    """Anchors, totals, dropped turns, kept turns and samples of more than 5,000 turns."""
    messages, limit = huge(5201, trailing), 90
    opts = PrepOptions(max_length=limit, extract_think_tags=False)
    turns = turn_table(spark, [(1, messages, None)])
    # Only the newest turns can fit; the plain rule would try every older start first.
    fitted = brute.fit(messages[:1] + messages[-trailing - 60 :], limit)
    last = max(i for i, m in enumerate(messages) if m["role"] == "assistant")
    size = len(brute.encode(brute.render(messages))[0])

    rows = prepare.turn_rows(turns, opts, text="content")
    row = truncation.drop_middle(
        truncation.truncation_anchors(rendering.tokenize_messages(rows)), limit
    ).first()
    assert row.messages[row.last_assistant].pos == last
    assert row.messages[row.tail_start].pos == last - 1
    assert (row.raw_total, row.over, row.dropped_turns) == (size, True, len(messages) - len(fitted))
    assert len(row.messages) < 2000

    kept = prepare.fitted_turns(turns, opts, text="content").orderBy("pos").collect()
    assert [(r.role, r.content, r.reasoning_content) for r in kept] == [
        (m["role"], m["content"], m["reasoning"]) for m in fitted
    ]
    assert "".join(r.rendered for r in kept) == brute.render(fitted)

    trace = prepare.prepare_turn_lengths(turns, opts, text="content").first()
    structured = len(brute.encode(brute.render(fitted))[0])
    assert (trace.raw_length, trace.structured_length, trace.final_length) == (size, structured, min(structured, limit))
    samples = prepare.prepare_turn_samples(turns, opts, text="content")
    assert collected(samples) == {1: brute.sample(messages, limit, fitted=fitted)}


@pytest.mark.parametrize("agreement", [None, 4])
def test_external_tokenizer_without_additive_counts(spark, agreement):
    """Pairs of characters as tokens: boundaries run across messages and tags."""

    def make():
        def encode(text):
            spans = [(i, min(i + 2, len(text))) for i in range(0, len(text), 2)]
            return [sum(map(ord, text[a:b])) for a, b in spans], spans

        return encode

    rows = brute.random_conversations(random.Random(3), 150)
    for settings in (
        {"max_length": 150, "think_loss": "answer_only"},
        {"max_length": 90, "think_loss": "answer_plus_think", "truncate_side": "right"},
    ):
        opts = PrepOptions(extract_think_tags=False, **settings)
        df = prepare_samples_with(list_table(spark, rows), ExternalTokenizer(make, eos_id=7, agreement=agreement), opts)
        assert collected(df) == expected(rows, settings, make(), 7)


@pytest.mark.parametrize("agreement", [None, 16])
def test_external_subword_tokenizer(spark, agreement):
    tokenizers = pytest.importorskip("tokenizers")
    trained = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="?"))
    trained.pre_tokenizer = tokenizers.pre_tokenizers.Split(tokenizers.Regex(r"\w+|\s+|\W"), "isolated")
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=200, show_progress=False, special_tokens=["?", "<|im_start|>", "<|im_end|>"]
    )
    rows = brute.random_conversations(random.Random(8), 80)
    trained.train_from_iterator([brute.render(m, t) for _, m, t in rows], trainer)
    as_json = trained.to_str()

    def make():
        import tokenizers

        loaded = tokenizers.Tokenizer.from_str(as_json)

        def encode(text):
            e = loaded.encode(text, add_special_tokens=False)
            return e.ids, e.offsets

        return encode

    settings = {"max_length": 80, "think_loss": "answer_only"}
    opts = PrepOptions(extract_think_tags=False, **settings)
    df = prepare_samples_with(list_table(spark, rows), ExternalTokenizer(make, agreement=agreement), opts)
    assert collected(df) == expected(rows, settings, make(), None)


def test_joined_counts_are_near_linear():
    """Counts of joined texts equal those of the whole; the encoded text grows with its length."""
    pattern = re.compile(r"\w{1,5}|\s+(?=\w)|\W")
    spent = 0

    def encode(text):
        nonlocal spent
        spent += len(text)
        found = list(pattern.finditer(text))
        return [hash(m.group()) for m in found], [m.span() for m in found]

    rng = random.Random(5)

    def prose(n):
        return " ".join("".join(rng.choices("ab é.<", k=rng.randrange(1, 12))) for _ in range(n))

    for n_parts in (100, 400):
        counts = JoinedCounts(encode, 16)
        parts, heads = [prose(20) for _ in range(n_parts)], [prose(20) for _ in range(n_parts)]
        left = prose(2000)
        spent, at, got = 0, 0, []
        start, whole = counts.known(left), counts.known("".join(parts))
        for head, part in zip(heads, parts):
            got.append(counts.count(start, head, whole, at))
            at += len(part)
        used = spent
        want = [len(encode(left + h + "".join(parts[i:]))[0]) for i, h in enumerate(heads)]
        assert got == want
        assert used <= 5 * (len(left) + len("".join(heads + parts)))
    # Parts whose tokens never meet are encoded whole.
    pairs = JoinedCounts(lambda t: ([0] * -(-len(t) // 2), [(i, min(i + 2, len(t))) for i in range(0, len(t), 2)]), 4)
    for n in range(4):
        assert pairs.count(pairs.known("x" * 1001), "y" * n, pairs.known("z" * 999), 5) == -(-(1995 + n) // 2)
    assert pairs.count(pairs.known(""), "", pairs.known("")) == 0


def test_a_false_statement_about_a_tokenizer_is_noticed(spark):
    """Characters count twice in long texts, so counts from parts are too low."""

    def make():
        def encode(text):
            times = 2 if len(text) > 150 else 1
            spans = [(i, i + 1) for i in range(len(text)) for _ in range(times)]
            return [ord(text[a]) for a, _ in spans], spans

        return encode

    rows = brute.random_conversations(random.Random(13), 60)
    settings = {"max_length": 250, "think_loss": "answer_only"}
    opts = PrepOptions(extract_think_tags=False, **settings)
    plug = ExternalTokenizer(make, agreement=4)
    assert collected(prepare_samples_with(list_table(spark, rows), plug, opts)) == expected(rows, settings, make(), None)


@pytest.mark.parametrize("atomic", [True, False])
def test_external_tokenizer_with_atomic_markers(spark, atomic):
    """The built-in split as a plug-in, by sums and by whole candidates, with capped reasoning."""

    pattern = brute.TOKEN_PATTERN

    def make():
        import hashlib

        import regex

        def encode(text):
            found = list(regex.finditer(pattern, text))
            return [int(hashlib.md5(m.group().encode()).hexdigest()[:15], 16) for m in found], [m.span() for m in found]

        return encode

    rows = brute.random_conversations(random.Random(21), 80)
    for settings in ({"max_length": 60, "think_loss": "answer_only"}, {"max_length": 30, "truncate_side": "right"}):
        opts = PrepOptions(extract_think_tags=False, **settings)
        plug = ExternalTokenizer(make, eos_id=brute.EOS, atomic_markers=atomic)
        df = prepare_samples_with(list_table(spark, rows), plug, opts)
        assert collected(df) == expected(rows, settings)


def test_external_cap(spark):
    """Reasoning is cut to the tokenizer's first n tokens."""

    def make():
        return lambda text: ([ord(c) for c in text], [(i, i + 1) for i in range(len(text))])

    def make_decode():
        return lambda ids: "".join(map(chr, ids))

    messages = [
        {"role": "user", "content": "q", "reasoning": None},
        {"role": "assistant", "content": "a", "reasoning": "thinking"},
    ]
    opts = PrepOptions(max_length=0, think_max_tokens=5, extract_think_tags=False)
    df = prepare_samples_with(list_table(spark, [(1, messages, None)]), ExternalTokenizer(make, make_decode=make_decode), opts)
    text = "".join(map(chr, df.first().input_ids))
    messages[1]["reasoning"] = "think"
    assert text == brute.render(messages)


def test_sample_properties(spark):
    rows = brute.random_conversations(random.Random(2), 200)
    opts = PrepOptions(max_length=40)
    samples = prepare.prepare_samples(list_table(spark, rows), opts)
    bad = samples.filter(
        (F.size("input_ids") > 40)
        | (F.size("input_ids") != F.size("labels"))
        | (F.size("input_ids") != F.size("attention_mask"))
        | (F.col("original_length") > F.col("raw_length"))
        | F.exists(
            F.zip_with("input_ids", "labels", lambda i, l: (l != -100) & (l != i)), lambda x: x
        )
    )
    assert bad.count() == 0 and samples.count() > 0
