"""Streams of single turns against the same turns as a table."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest

from turnloom.options import PrepOptions
from turnloom.plans.prepare import prepare_samples
from turnloom.sources import tables
from turnloom.streaming import conversations_of_turns, prepare_turn_stream
from turnloom.streaming.turns import _cut

SCHEMA = "conv_id long, turn long, role string, text string, event_time timestamp, role_name string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
IDLE = 600
MOST = 5


def turn(conv, order, seconds, text="words of a turn", role=None):
    role = role or ("user", "assistant")[order % 2]
    return (conv, order, role, text, START + timedelta(seconds=seconds), "extra")


def plain_rows(turns, most=MOST, idle=IDLE):
    """Rows of complete conversations: cut at pauses, then into rows of `most` turns."""
    by_conv = {}
    for t in turns:
        by_conv.setdefault(t[0], {}).setdefault(t[1], t)
    rows = {}
    for conv, held in by_conv.items():
        row = []
        for t in (held[k] for k in sorted(held)):
            if row and (len(row) == most or (t[4] - row[-1][4]).total_seconds() > idle):
                rows[(conv, row[0][1])] = [(x[2], x[3]) for x in row]
                row = []
            row.append(t)
        rows[(conv, row[0][1])] = [(x[2], x[3]) for x in row]
    return rows


def run(spark, batches, tmp_path, **options):
    """Rows after each batch of a stream that is stopped and continued."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    seen = []
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = tables.read_conversations(spark, source, schema=spark.createDataFrame([], SCHEMA).schema, streaming=True)
        rows = conversations_of_turns(stream, idle=IDLE, lateness="2 minutes", max_turns=MOST, **options)
        query = (
            rows.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True)
            .start()
        )
        assert query.awaitTermination(180)
        found = spark.read.schema(rows.schema).parquet(out).collect()
        seen.append({(r.conv_id, r.first_turn): [(m.role, m.content) for m in r.messages] for r in found})
        assert len(seen[-1]) == len(found), f"a row came twice in batch {i}"
    return seen


def test_stream_of_turns_equals_the_table(spark, tmp_path):
    rng = random.Random(3)
    turns = []
    for conv in range(6):
        at = rng.randrange(300)
        for order in range(rng.randrange(1, 14) if conv else 23):
            turns.append(turn(conv, order, at, f"text {conv} {order} née"))
            # Pauses around the idle time; conversation 0 never pauses and fills rows.
            at += rng.choice([1, 20, 60]) if not conv else rng.choice([0, 5, 590, 600, 601, 900])
    turns.sort(key=lambda t: (t[4], t[1]))
    batches = [[], [], []]
    for i, t in enumerate(turns):
        batches[i * 3 // len(turns)].append(t)
    for batch in batches:
        rng.shuffle(batch)
    batches[1] += [batches[1][0], (None, 1, "user", "no key", START, ""), (1, None, "user", "no place", START, "")]
    batches[1] += [(1, 1, "user", "no time", None, "")]
    end = max(t[4] for t in turns)
    closing = turn(99, 0, (end - START).total_seconds() + 10_000)
    # Long behind the watermark by then: dropped.
    late = turn(0, 1000, 0, "late")
    seen = run(spark, [*batches, [closing], [late, turn(99, 1, (end - START).total_seconds() + 10_001)]], tmp_path)
    want = plain_rows(turns)
    assert seen[3] == want
    assert seen[4] == want  # 99 is held, the late turn is gone
    assert all(rows.items() <= want.items() for rows in seen)
    # Full rows of the long conversation leave while it goes on.
    assert any(conv == 0 for conv, _ in seen[1])


def test_a_turn_in_time_after_the_close_opens_a_row(spark, tmp_path):
    batches = [
        [turn(1, 0, 0, "a"), turn(1, 1, 10, None)],
        [turn(2, 0, 2000, "b")],
        [turn(1, 2, 2100, ""), turn(2, 1, 2100, "c", role="tool")],
        [turn(3, 0, 9000, "d")],
    ]
    seen = run(spark, batches, tmp_path)
    first = {(1, 0): [("user", "a"), ("assistant", None)]}
    assert seen[0] == {} and seen[1] == first and seen[2] == first
    assert seen[3] == {**first, (1, 2): [("user", "")], (2, 0): [("user", "b"), ("tool", "c")]}


def test_samples_of_a_stream_of_turns(spark, tmp_path):
    opts = PrepOptions(max_length=64)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    turns = [turn(c, o, 10 * o, f"text {c} {o} " + "word " * 8) for c in range(4) for o in range(6)]
    table = spark.createDataFrame([*turns, turn(9, 0, 9000)], SCHEMA)
    table.write.parquet(source)
    stream = tables.read_conversations(spark, source, schema=table.schema, streaming=True)
    query = prepare_turn_stream(stream, out, "turns", opts, checkpoint=str(tmp_path / "progress"), idle=IDLE)
    assert query.awaitTermination(180)
    whole = [(c, 0, [{"role": t[2], "content": t[3]} for t in turns if t[0] == c]) for c in range(4)]
    lists = spark.createDataFrame(whole, "conv_id long, first_turn long, messages array<struct<role:string,content:string>>")
    want = prepare_samples(lists, opts, ("conv_id", "first_turn"))
    assert sorted(spark.read.parquet(out).collect()) == sorted(want.collect())


@pytest.mark.parametrize("seed", range(20))
def test_rows_do_not_depend_on_when_turns_come(seed):
    rng = random.Random(seed)
    times = sorted(rng.choices(range(0, 4000, 50), k=40))
    turns = [(i, at, "user", str(i)) for i, at in enumerate(times)]
    want, _ = _cut(turns, 10**9, 200, 7)
    held, rows, settled = [], [], 0
    # Turns come out of order by at most 300; the watermark follows the latest by 300.
    for t in sorted(turns, key=lambda t: t[1] + rng.randrange(300)):
        held = sorted([*held, t])
        done, held = _cut(held, settled, 200, 7)
        rows += done
        settled = max(settled, t[1] - 300)
    done, held = _cut(held, 10**9, 200, 7)
    assert rows + done == want and not held
    assert [t for row in want for t in row] == turns
    assert max(map(len, want)) <= 7
