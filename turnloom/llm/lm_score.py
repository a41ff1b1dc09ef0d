"""Language-model scores of whole documents.

1. Tasks split their texts into blocks and list each block's distinct words once; the
   blocks' texts become numbers into that list. Both are written.
2. Word counts over all training texts come from a shuffle of the lists, and go back to
   the blocks by joins, so no task or driver holds the vocabulary.
3. The most frequent words are symbols of a recurrent model; each other word is
   one of a fixed number of tail symbols. A word's probability is that of its symbol
   times, in the tail, the word's own share from the corpus counts.
4. Replicas of the model train, one for each partition, and their parameters are averaged
   after every round. Each round has its own training documents; together they have all.
5. One narrow pass scores all documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import col, crc32_text, nullable, pieces, text_or_empty, written

HEAD_WORDS = 2_000
HEAD_CLASSES = 32
TAIL_SYMBOLS = 32
# Tail symbols of one class of the softmax.
TAIL_CLASS = 8
BLOCK_BYTES = 12 << 20
# Texts of so many bytes (or one longer text) are numbered at once, which bounds a task's memory.
PIECE_BYTES = 2 << 20
# Each training document is shown in one of so many rounds.
ROUNDS = 4
# A replica trains on so many tokens at once (up to half as many more, or one longer text), which bounds its memory.
TRAIN_TOKENS = 1 << 20
VALUES_PER_ROW = 4_096
END = b""


def _held_out(name: Column) -> Column:
    return crc32_text(name) % 5 == 1


def tail_symbol(word: bytes) -> int:
    """The tail symbol of a word: by its last two bytes, which tell languages and styles apart."""
    return zlib.crc32(word[-2:]) % TAIL_SYMBOLS


def numbered() -> defaultdict[bytes, int]:
    """Numbers of words in the order of their first use; the end is 0."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    known[END] = 0
    return known


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows of two kinds. Documents: block, id, held_out, codes. Words: block, word, tail,
    code, n_train (occurrences in the block's training documents)."""
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "held_out", _held_out(F.col("id"))
    )
    schema = nullable(source.select(
        F.lit(0).cast("long").alias("block"),
        "id",
        "held_out",
        F.lit(b"").alias("codes"),
        F.lit(b"").alias("word"),
        F.lit(0).alias("tail"),
        F.lit(0).alias("code"),
        F.lit(0).cast("long").alias("n_train"),
    ).schema)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        known = numbered()
        counted = np.zeros(1, np.int64)
        seen = 0

        def listed() -> Iterator[pa.RecordBatch]:
            words = list(known)
            for begin in range(0, len(words), 100_000):
                part = words[begin : begin + 100_000]
                n = len(part)
                columns = {
                    "block": pa.array(np.full(n, block)),
                    "id": pa.nulls(n, id_type),
                    "held_out": pa.nulls(n, pa.bool_()),
                    "codes": pa.nulls(n, pa.binary()),
                    "word": pa.array(part, pa.binary()),
                    "tail": pa.array([tail_symbol(w) for w in part], pa.int32()),
                    "code": pa.array(np.arange(begin, begin + n, dtype=np.int32)),
                    "n_train": pa.array(counted[begin : begin + n]),
                }
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal seen, counted
            codes, shown = [], [np.empty(0, np.int32)]
            for text, apart in zip(batch.column("text").cast(pa.binary()), batch.column("held_out").to_pylist()):
                found = text.as_py()
                seen += len(found)
                found = found.lower().split()
                found.append(END)
                row = np.fromiter(map(known.__getitem__, found), np.int32, len(found))
                codes.append(row.tobytes())
                if not apart:
                    shown.append(row)
            times = np.bincount(np.concatenate(shown), minlength=len(known))
            times[: len(counted)] += counted
            counted = times
            n = batch.num_rows
            columns = {
                "block": pa.array(np.full(n, block)),
                "id": batch.column("id"),
                "held_out": batch.column("held_out"),
                "codes": pa.array(codes, pa.binary()),
                "word": pa.nulls(n, pa.binary()),
                "tail": pa.nulls(n, pa.int32()),
                "code": pa.nulls(n, pa.int32()),
                "n_train": pa.nulls(n, pa.int64()),
            }
            return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        id_type = pa.null()
        for batch in batches:
            id_type = batch.column("id").type
            yield from map(coded, pieces(batch, "text", PIECE_BYTES))
            if seen >= block_bytes:
                yield from listed()
                block, known, seen = block + 1, numbered(), 0
                counted = np.zeros(1, np.int64)
        if seen or len(known) > 1 or counted[0] or id_type != pa.null():
            yield from listed()

    return source.mapInArrow(run, schema)


def _encoded(parts: DataFrame, words: DataFrame, total: float, known: int, tails: np.ndarray, head: int) -> DataFrame:
    """Documents with their base score, the tail part of the model's score, and symbols."""
    documents = parts.filter("codes IS NOT NULL").select("block", "id", "held_out", "codes")
    schema = documents.select(
        "id",
        "held_out",
        F.lit(0).cast("long").alias("n_tokens"),
        F.lit(0).cast("long").alias("n_known"),
        F.lit(0.0).alias("base_score"),
        F.lit(0.0).alias("tail_score"),
        F.lit(b"").alias("symbols"),
    ).schema

    def score(rows: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(len(listed), np.int64)
        c[listed["code"]] = listed["c"]
        symbol = np.zeros(len(listed), np.uint16)
        symbol[listed["code"]] = listed["symbol"]
        base = np.log10((c + 0.5) / (total + 0.5 * (known + 1)))
        in_tail = symbol >= head
        n, v = tails[symbol[in_tail] - head].T
        own = np.zeros(len(listed))
        own[in_tail] = np.log10(np.where(c[in_tail] > 0, c[in_tail] - 0.5, 0.5 * v + 0.5) / (n + 0.5))
        is_known = c > 0
        out = []
        for row in rows.itertuples(index=False):
            codes = np.frombuffer(row.codes, np.int32)
            out.append(
                (row.id, row.held_out, len(codes), int(is_known[codes].sum()), base[codes].sum(), own[codes].sum(), symbol[codes].tobytes())
            )
        return pd.DataFrame(out, columns=schema.names).astype({"id": rows["id"].dtype})

    return documents.groupBy("block").cogroup(words.groupBy("of_block")).applyInPandas(score, schema)


def _round(id_col: str) -> Column:
    """The round in which a training document is shown."""
    return F.pmod(F.xxhash64(id_col), F.lit(ROUNDS))


def groups(texts: Iterable[np.ndarray], tokens: int) -> Iterator[list[np.ndarray]]:
    """All texts in groups of `tokens` tokens or more. A rest of under half as many joins the
    group before it: by itself it would take as many updates, and so be shown again and again."""
    before, now, held = [], [], 0
    for text in texts:
        now.append(text)
        held += len(text)
        if before and held >= tokens // 2:
            yield before
            before = []
        if held >= tokens:
            before, now, held = now, [], 0
    if before or now:
        yield before + now


def _averaged(encoded: DataFrame, vector: np.ndarray, shape: gru.Shape, start: int) -> np.ndarray:
    """Train one replica for each partition and average them, weighted by their tokens."""

    def replica(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, weight = vector, 0.0
        shown = (np.frombuffer(s.as_py(), np.uint16) for b in batches for s in b.column("symbols"))
        for texts in groups(shown, TRAIN_TOKENS):
            now, weight = gru.train(now, shape, texts, start), weight + sum(map(len, texts))
        if not weight:
            return
        trained = now.astype(np.float64) * weight
        for row, begin in enumerate(range(0, len(trained), VALUES_PER_ROW)):
            part = trained[begin : begin + VALUES_PER_ROW].tobytes()
            yield pa.RecordBatch.from_pydict(
                {"row": [row], "part": [TaskContext.get().partitionId() % 64], "weight": [weight], "sums": [part]}
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for row, _, weight, raw in zip(*(c.to_pylist() for c in batch.columns)):
                sums = np.frombuffer(raw)
                old = held.get(row)
                held[row] = [old[0] + weight, old[1] + sums] if old else [weight, sums]
        for row, (weight, sums) in held.items():
            yield pa.RecordBatch.from_pydict({"row": [row], "part": [0], "weight": [weight], "sums": [sums.tobytes()]})

    schema = "row long, part long, weight double, sums binary"
    some = encoded.select("symbols").mapInArrow(replica, schema).repartition("row", "part").mapInArrow(merge, schema)
    # The parameters have a fixed number, whatever the corpus.
    rows = some.repartition("row").mapInArrow(merge, schema).collect()
    if not rows:
        return vector
    rows.sort(key=lambda r: r["row"])
    return np.concatenate([np.frombuffer(r["sums"]) / r["weight"] for r in rows]).astype(np.float32)


def language_model_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the whole text and its end. NULL texts count as
    empty and consist of their end only. NULL ids count as the empty text in the choice
    of training documents. Repeated rows count as often as they occur. Without training
    documents every word is unknown.
    """
    parts = written(blocks(docs, id_col, text_col, block_bytes))
    listed = parts.filter("word IS NOT NULL").select("block", "word", "tail", "code", "n_train")
    counts = written(listed.groupBy("word").agg(F.sum("n_train").alias("c"), F.first("tail").alias("tail")).filter("c > 0"))
    total, known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    # At most HEAD_WORDS rows, small enough to be broadcast.
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).collect()
    head = {bytes(r["word"]): i for i, r in enumerate(top)}
    spark = docs.sparkSession
    symbols = spark.createDataFrame(list(head.items()), "word binary, symbol int")
    tails = np.zeros((TAIL_SYMBOLS, 2))
    rest = counts.join(F.broadcast(symbols), "word", "left_anti")
    for row in rest.groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        tails[row["tail"]] = row["n"], row["v"]
    words = (
        listed.join(counts.select("word", "c"), "word", "left")
        .join(F.broadcast(symbols), "word", "left")
        .select(F.col("block").alias("of_block"), "code", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("symbol", F.col("tail") + len(head)).alias("symbol"))
    )
    encoded = written(_encoded(parts, words, float(total), known, tails, len(head)))

    frequency = np.array([r["c"] for r in top], np.float64)
    mass = np.cumsum(np.sqrt(frequency))
    bins = np.searchsorted(mass, np.arange(HEAD_CLASSES) * (mass[-1] / HEAD_CLASSES)) if len(top) else np.empty(0, int)
    starts = (*np.unique(bins).tolist(), *range(len(head), len(head) + TAIL_SYMBOLS, TAIL_CLASS))
    shape = gru.Shape(len(head) + TAIL_SYMBOLS, tuple(int(s) for s in starts))
    start = head.get(END, len(head))
    vector = gru.initial(shape, np.concatenate([frequency, tails[:, 0]]))
    for turn in range(ROUNDS):
        shown = encoded.filter(~F.col("held_out") & (_round("id") == turn))
        vector = _averaged(shown, vector, shape, start)

    source = encoded.select("id", "held_out", "n_tokens", "n_known", "base_score", "tail_score", "symbols")
    schema = encoded.select("id", "held_out", "n_tokens", "n_known", "base_score", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = gru.unpack(vector, shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [np.frombuffer(s.as_py(), np.uint16) for s in batch.column("symbols")]
            score = gru.text_scores(p, shape, texts, start) / np.log(10)
            score = score + batch.column("tail_score").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "held_out", "n_tokens", "n_known", "base_score")), pa.array(score)],
                names=schema.names,
            )

    return source.mapInArrow(run, schema).withColumn("train_tokens", F.lit(int(total)).cast("long"))
