"""The stored histogram against the report over all rows."""

from __future__ import annotations

import random

import pytest

import brute
from test_truncation import list_table
from turnloom import PrepOptions
from turnloom.operators import stats
from turnloom.plans import prepare
from turnloom.sources import tables
from turnloom.streaming import length_stream, lengths

OPTS = PrepOptions(max_length=60)


def report(found):
    return {name: sorted(map(tuple, df.collect()), key=repr) for name, df in found.items()}


def expected(spark, rows):
    return report(stats.length_report(prepare.prepare_lengths(list_table(spark, rows), OPTS), 60))


def test_repeated_batches_count_once(spark, tmp_path):
    rows, path = brute.random_conversations(random.Random(3), 90), str(tmp_path / "store")
    batches = [prepare.prepare_lengths(list_table(spark, rows[i::3]), OPTS) for i in range(3)]
    assert lengths.length_report(spark, path, 60)["raw_lengths"].collect() == []
    for i in (0, 1, 1, 2):
        lengths.add_batch(batches[i], path, "chats", i)
    assert report(lengths.length_report(spark, path, 60)) == expected(spark, rows)
    lengths.compact(spark, path)
    lengths.add_batch(batches[1], path, "chats", 1)  # what was compacted is not counted again
    assert report(lengths.length_report(spark, path, 60)) == expected(spark, rows)
    lengths.add_batch(batches[0], path, "chats", 3)
    lengths.add_batch(batches[2], path, "others", 0)  # another stream has its own ids
    lengths.compact(spark, path)
    assert report(lengths.length_report(spark, path, 60)) == expected(spark, rows + rows[0::3] + rows[2::3])
    with pytest.raises(ValueError):
        lengths.add_batch(batches[0], path, "a/b", 0)


def test_stream_adds_what_is_new(spark, tmp_path):
    rows = brute.random_conversations(random.Random(9), 40)
    source, path, progress = (str(tmp_path / n) for n in ("source", "store", "progress"))
    table = list_table(spark, rows)
    schema = table.schema
    done = []
    for part in (rows[:15], rows[15:]):
        list_table(spark, part).write.mode("append").parquet(source)
        done += part
        stream = tables.read_conversations(spark, source, schema=schema, streaming=True)
        assert length_stream(stream, path, "chats", OPTS, checkpoint=progress).awaitTermination(120)
        assert report(lengths.length_report(spark, path, 60)) == expected(spark, done)
