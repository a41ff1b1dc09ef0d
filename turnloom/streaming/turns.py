"""Conversations from streams of single turns.

Turns are kept by conversation until they are settled: their event time is behind the
watermark, so no turn that counts can come before them. Settled turns leave the state as rows of
at most ``max_turns`` turns in order, a full row as soon as there is one, and the rest when the
conversation has been idle: nothing came for ``idle`` of event time. So the state of a
conversation holds fewer than ``max_turns`` settled turns and those within the watermark's delay.
A task also holds what one batch brings for a conversation; ``maxFilesPerTrigger`` and the like
bound that.

Turns that come late have one of two outcomes. A turn whose time is behind the watermark is
dropped, and Spark counts it in the query's progress. A turn in time after its conversation was
closed opens a further row, as after an idle pause in a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..options import PrepOptions
from ..plans.prepare import prepare_samples
from ..sources.turns import MAX_TURNS_PER_ROW
from .samples import checkpoint_location

IDLE_SECONDS = 1800
LATENESS = "10 minutes"

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)
# Turns held: parallel arrays, in order.
HELD = "place array<bigint>, at array<bigint>, role array<string>, content array<string>"


def _cut(held: list[tuple], settled: int, idle: int, most: int) -> tuple[list[list[tuple]], list[tuple]]:
    """Rows that are complete among turns in order, and the turns still held.

    A row ends where it is full and before a pause of more than ``idle`` after its last turn.
    Only settled turns leave, and a pause counts once it is settled itself.
    """
    done, row = [], []
    for i, turn in enumerate(held):
        if row and (len(row) == most or row[-1][1] + idle < min(turn[1], settled)):
            done.append(row)
            row = []
        if turn[1] >= settled:
            # What follows may still change, and with it where the open row ends.
            return done, [*row, *held[i:]]
        row.append(turn)
    if row and (len(row) == most or row[-1][1] + idle < settled):
        done.append(row)
        row = []
    return done, row


def _value(text: object) -> str | None:
    return text if isinstance(text, str) else None


def conversations_of_turns(
    stream: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    time: str = "event_time",
    idle: int = IDLE_SECONDS,
    lateness: str = LATENESS,
    max_turns: int = MAX_TURNS_PER_ROW,
) -> DataFrame:
    """``key, first_turn, messages`` of a stream of turns, each row given once when it is complete.

    ``first_turn`` is the order value of the row's first turn and names the row within its
    conversation. ``time`` is a timestamp that does not fall along ``order``; ``idle`` is in
    seconds. Turns without key, order value or time belong nowhere and are left out. Turns that
    come twice (same order value) count once while they are held. Append mode.
    """
    pause = idle * 1_000_000
    source = {f.name: f.dataType for f in stream.schema}
    out = T.StructType(
        [T.StructField(key, source[key]), T.StructField("first_turn", T.LongType()), T.StructField("messages", MESSAGES)]
    )
    turns = (
        stream.select(
            F.col(key).alias("_key"),
            F.col(order).cast("long").alias("_place"),
            F.col(role).cast("string").alias("_role"),
            F.col(text).cast("string").alias("_content"),
            F.col(time).cast("timestamp").alias("_time"),
        )
        .filter(F.col("_key").isNotNull() & F.col("_place").isNotNull() & F.col("_time").isNotNull())
        .withColumn("_at", F.unix_micros("_time"))
        .withWatermark("_time", lateness)
    )

    def settle(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {turn[0]: turn for turn in zip(*state.get)} if state.exists else {}
        for batch in batches:
            for place, at, who, what in zip(batch["_place"], batch["_at"], batch["_role"], batch["_content"]):
                held.setdefault(int(place), (int(place), int(at), _value(who), _value(what)))
        settled = state.getCurrentWatermarkMs() * 1000
        turns = [held[place] for place in sorted(held)]
        done, left = _cut(turns, settled, pause, max_turns)
        if left:
            state.update(tuple(list(column) for column in zip(*left)))
            # The first moment at which the turns that are held could end a row.
            ends = max(t[1] for t in left) + pause if left[-1][1] < settled else max(t[1] for t in left)
            state.setTimeoutTimestamp(max(ends // 1000 + 1, settled // 1000 + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(
                {
                    key: [name[0]] * len(done),
                    "first_turn": [row[0][0] for row in done],
                    "messages": [[{"role": t[2], "content": t[3]} for t in row] for row in done],
                }
            )

    return turns.groupBy("_key").applyInPandasWithState(settle, out, HELD, "append", GroupStateTimeout.EventTimeTimeout)


def prepare_turn_stream(
    stream: DataFrame,
    path: str,
    name: str,
    opts: PrepOptions = PrepOptions(),
    key: str = "conv_id",
    checkpoint: str | None = None,
    **columns,
) -> StreamingQuery:
    """Write the samples of all conversations that are complete by now as Parquet and stop.

    ``columns`` are the further arguments of :func:`conversations_of_turns`. Samples carry the
    key and ``first_turn``. Turns still held are in the query's state for its next run.
    """
    location = checkpoint or checkpoint_location(stream.sparkSession, name)
    rows = conversations_of_turns(stream, key, **columns)
    return (
        prepare_samples(rows, opts, (key, "first_turn"))
        .writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
