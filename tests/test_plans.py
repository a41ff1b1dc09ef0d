"""Shape of the plans, streams, sources and sinks."""

from __future__ import annotations

import random
import re

import pytest

import brute
from test_truncation import list_table, turn_table
from turnloom import PrepOptions
from turnloom.plans import prepare
from turnloom.sources import tables, turns as turn_ops
from turnloom.streaming import prepare_stream


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange\b", plan_of(df)))


@pytest.fixture(scope="module")
def rows():
    return brute.random_conversations(random.Random(4), 40)


def test_message_lists_need_no_shuffle_and_no_python(spark, rows, tmp_path):
    path = str(tmp_path / "lists")
    list_table(spark, rows).write.parquet(path)
    samples = prepare.prepare_samples(spark.read.parquet(path), PrepOptions(max_length=50))
    assert exchanges(samples) == 0
    assert "Python" not in plan_of(samples)


def test_turn_plans_start_no_job_and_stay_in_the_jvm(spark, rows, tmp_path):
    path = str(tmp_path / "turns")
    turn_table(spark, rows).write.parquet(path)
    turns = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("building", "plans only")
    samples = prepare.prepare_turn_samples(turns, PrepOptions(max_length=50), text="content")
    prepare.prepare_turn_lengths(turns, PrepOptions(max_length=50), text="content")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    assert "Python" not in plan_of(samples)
    canonical = turn_ops.canonical_turns(turns, PrepOptions(), text="content")
    assert exchanges(canonical) == 0
    only_keys = turn_ops.conversation_totals(canonical).select("conv_id", "n_messages")
    assert "reasoning_content" not in plan_of(only_keys).split("ReadSchema")[-1]


def test_key_filters_reach_the_scan(spark, rows, tmp_path):
    lists, turns = str(tmp_path / "lists"), str(tmp_path / "turns")
    list_table(spark, rows).write.parquet(lists)
    turn_table(spark, rows).write.parquet(turns)
    opts = PrepOptions(max_length=50)
    for df in (
        prepare.prepare_samples(spark.read.parquet(lists), opts),
        prepare.prepare_turn_samples(spark.read.parquet(turns), opts, text="content"),
    ):
        assert "EqualTo(conv_id,3)" in plan_of(df.filter("conv_id = 3"))


def test_parts_go_by_rank(spark):
    for orders in ([1, 2, 3, 4], [1_700_000_000_000 + 977 * i for i in range(4)]):
        turns = spark.createDataFrame([(7, o, "user", str(i)) for i, o in enumerate(orders)], "conv_id long, turn long, role string, text string")
        parts = turn_ops.assemble_conversations(turns, max_turns=3).orderBy("part").collect()
        assert [(r.part, [m.content for m in r.messages]) for r in parts] == [(0, ["0", "1", "2"]), (1, ["3"])]


def test_a_missing_key_is_a_key(spark):
    pieces = spark.createDataFrame([(None, 0, "ab"), (None, 1, "c"), (1, 0, "d")], "conv_id long, turn long, rendered string")
    found = {(r.conv_id, r.turn): (r.span_start, r.span_end) for r in turn_ops.role_spans(pieces).collect()}
    assert found == {(None, 0): (0, 2), (None, 1): (2, 3), (1, 0): (0, 1)}
    assert turn_ops.token_offsets(pieces).count() == 3


def test_tokens_stay_with_their_message(spark, rows, tmp_path):
    path = str(tmp_path / "pieces")
    turn_table(spark, rows).selectExpr("conv_id", "turn", "content AS rendered").write.parquet(path)
    plan = plan_of(turn_ops.token_offsets(spark.read.parquet(path)))
    above = plan.split("Generate")[0]
    assert "Exchange" not in above


def test_split_is_a_partition_filter(spark, tmp_path):
    path = str(tmp_path / "split")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "conv_id long, split string")
    df.write.partitionBy("split").parquet(path)
    train = tables.read_conversations(spark, path, split="train")
    assert [r.conv_id for r in train.collect()] == [1]
    assert "PartitionFilters: [isnotnull(split" in plan_of(train)
    with pytest.raises(ValueError):
        tables.read_conversations(spark, "")


def test_long_conversations_continue_in_parts(spark, rows):
    turns = turn_table(spark, rows)
    parts = turn_ops.assemble_conversations(turns, text="content", max_turns=3).collect()
    assert max(len(r.messages) for r in parts) <= 3
    joined = {}
    for r in sorted(parts, key=lambda r: (r.conv_id, r.part)):
        joined.setdefault(r.conv_id, []).extend((m.role, m.content) for m in r.messages)
    assert joined == {key: [(m["role"], m["content"]) for m in messages] for key, messages, _ in rows}


def test_running_totals_do_not_depend_on_the_block_size(spark, rows):
    turns = turn_table(spark, rows).selectExpr("conv_id", "turn", "length(content) AS n")
    found = [
        sorted(map(tuple, turn_ops.running_total(turns, "conv_id", "turn", turns.n, "before", block).collect()))
        for block in (2, 65536)
    ]
    assert found[0] == found[1]


def test_stream_equals_batch_and_samples_round_trip(spark, rows, tmp_path):
    source, out, batch = (str(tmp_path / n) for n in ("source", "out", "batch"))
    table = list_table(spark, rows)
    table.repartition(3).write.parquet(source)
    opts = PrepOptions(max_length=50, think_loss="answer_only")
    stream = tables.read_conversations(spark, source, schema=table.schema, streaming=True)
    query = prepare_stream(stream, out, "samples", opts)
    assert query.awaitTermination(120)
    tables.write_samples(prepare.prepare_samples(table, opts), batch, shards=2)
    key = lambda df: sorted((r.conv_id, r.input_ids, r.labels) for r in df.collect())
    assert key(spark.read.parquet(out)) == key(spark.read.parquet(batch)) != []
    tables.write_report(spark.read.parquet(batch).groupBy().count(), str(tmp_path / "report"), "json")
    assert spark.read.json(str(tmp_path / "report")).first()["count"] > 0
