"""Quality classifier: random-indexing word vectors, pooled, under a small network.

1. Every word bucket has a fixed sparse random index vector. One pass over all texts
   adds, for each word, the index vectors of its neighbours to the word's context
   vector. Each task adds up its own table; tables are summed as Spark rows.
2. A document is the mean and the spread of its words' context vectors.
3. A two-layer network is fitted in numpy on a bounded sample of labelled documents,
   and its logit is divided by a temperature fitted on rows kept apart.
4. All documents are scored in one narrow pass.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, crc32_text, pieces, text_or_empty

BUCKETS = 1 << 15
DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
ROWS_PER_CHUNK = 512
TEXT_BYTES = 1 << 20
MEMO_WORDS = 300_000
# At most so many labelled documents are used for fitting; all of them up to there.
FIT_ROWS = 20_000
TOKEN = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class Model:
    """Weights of the network, input scaling, and the temperature of its logit."""

    center: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.center) / self.scale @ self.hidden + self.hidden_bias)
        return (h @ self.out + self.out_bias).astype(np.float64)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))


class Words:
    """Words of texts as bucket numbers; remembered, as words repeat."""

    def __init__(self) -> None:
        self._memo: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words end to end, and the number of words of each text."""
        found = [TOKEN.findall(text) for text in texts]
        unknown = set().union(*found).difference(self._memo)
        if len(self._memo) + len(unknown) > MEMO_WORDS:
            self._memo.clear()
            unknown = set().union(*found)
        self._memo.update((w, zlib.crc32(w.encode()) & (BUCKETS - 1)) for w in unknown)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.empty(int(counts.sum()), np.int64)
        at = 0
        for words in found:
            ids[at : at + len(words)] = list(map(self._memo.__getitem__, words))
            at += len(words)
        return ids, counts


def index_vectors() -> np.ndarray:
    """NONZERO random coordinates of each bucket are 1 or -1."""
    rng = np.random.default_rng(20_240)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    np.put_along_axis(vectors, places, rng.choice((-1, 1), (BUCKETS, NONZERO)).astype(np.float32), 1)
    return vectors


def _neighbours(ids: np.ndarray, counts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each word, the sum of the index vectors of up to WINDOW words on either side
    within its text."""
    owner = np.repeat(np.arange(len(counts)), counts)
    own = index[ids]
    total = np.zeros_like(own)
    for step in range(1, WINDOW + 1):
        same = (owner[step:] == owner[:-step])[:, None]
        total[:-step] += own[step:] * same
        total[step:] += own[:-step] * same
    return total


def _sum_by(keys: np.ndarray, rows: np.ndarray, into: np.ndarray) -> None:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    into[keys[first]] += np.add.reduceat(rows[order], first, axis=0)


def context_vectors(texts: DataFrame) -> np.ndarray:
    """Context vectors of all word buckets over the whole column `text`.

    The table has a fixed size (BUCKETS x DIMENSIONS), so the driver holds one such
    table whatever the corpus.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, index = Words(), index_vectors()
        table = np.zeros((BUCKETS, DIMENSIONS), np.float32)
        task = TaskContext.get().partitionId() % 64  # the same when a task is repeated
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                ids, counts = words(part.column("text").to_pylist())
                if len(ids):
                    _sum_by(ids, _neighbours(ids, counts, index), table)
        for chunk in range(BUCKETS // ROWS_PER_CHUNK):
            rows = table[chunk * ROWS_PER_CHUNK : (chunk + 1) * ROWS_PER_CHUNK]
            if rows.any():
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [chunk], "part": [task], "sums": [rows.tobytes()]}
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
                rows = np.frombuffer(raw, np.float32)
                sums[chunk] = sums[chunk] + rows if chunk in sums else rows
        for chunk, rows in sums.items():
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "part": [0], "sums": [rows.tobytes()]})

    schema = "chunk long, part long, sums binary"
    parts = texts.mapInArrow(add_up, schema)
    # Two steps, so that no task receives one piece from every task of the first.
    some = parts.repartition("chunk", "part").mapInArrow(merge, schema)
    whole = some.repartition("chunk").mapInArrow(merge, schema)
    table = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    for row in whole.collect():
        begin = row["chunk"] * ROWS_PER_CHUNK
        table[begin : begin + ROWS_PER_CHUNK] = np.frombuffer(row["sums"], np.float32).reshape(-1, DIMENSIONS)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(length, 1e-6)).astype(np.float32)


def pooled(texts: list[str], words: Words, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the word vectors of each text; zeros without words."""
    ids, counts = words(texts)
    out = np.zeros((len(texts), 2 * DIMENSIONS), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        rows = vectors[ids]
        starts = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
        n = counts[some][:, None].astype(np.float32)
        mean = np.add.reduceat(rows, starts, axis=0) / n
        square = np.add.reduceat(rows * rows, starts, axis=0) / n
        out[some] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0))])
    return out


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 40, seed: int = 7) -> Model:
    """The network by Adam on four fifths of the rows, the temperature on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    apart, used = order[: len(x) // 5], order[len(x) // 5 :]
    center, scale = x[used].mean(0), x[used].std(0) + 1e-4
    z, t = ((x[used] - center) / scale).astype(np.float32), y[used].astype(np.float32)
    weights = [
        (rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1])).astype(np.float32),
        np.zeros(hidden, np.float32),
        (rng.standard_normal(hidden) / np.sqrt(hidden)).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(z))
        for begin in range(0, len(z), 256):
            rows = shuffled[begin : begin + 256]
            a = z[rows]
            h = np.tanh(a @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -60, 60))) - t[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - h * h)
            gradients = [a.T @ back + 1e-4 * weights[0], back.sum(0), h.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(center, scale, *weights[:3], float(weights[3][0]), 1.0)
    if not len(apart):
        return model
    logit, truth = model.logit(x[apart]), y[apart]
    temperatures = np.geomspace(0.25, 16, 61)
    losses = [np.logaddexp(0, logit / t).mean() - (truth * logit / t).mean() for t in temperatures]
    return Model(center, scale, *weights[:3], float(weights[3][0]), float(temperatures[int(np.argmin(losses))]))


def neutral() -> Model:
    """Without labels of both kinds every text scores one half."""
    n = 2 * DIMENSIONS
    return Model(np.zeros(n), np.ones(n), np.zeros((n, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit_rows: int) -> DataFrame:
    """(text, label) of at most `fit_rows` documents, chosen by a hash of their id.

    Only labels 0 and 1 of ids whose crc32 modulo 3 is not 1 count; of repeated
    labels of an id the larger one. The chosen ids are as bounded as `fit_rows`.
    """
    chosen = (
        labels.select(col(id_col).alias("id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .filter(crc32_text(F.col("id")) % 3 != 1)
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"))
        .limit(fit_rows)
    )
    return docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS
) -> tuple[np.ndarray, Model]:
    """Word vectors from all of `docs` and the network from its labelled rows."""
    vectors = context_vectors(docs.select(text_or_empty(text_col).alias("text")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                x = pooled(part.column("text").to_pylist(), words, vectors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").cast(pa.string()), part.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["id", "label", "x"],
                )

    chosen = labelled_rows(docs, labels, id_col, text_col, fit_rows)
    rows = chosen.mapInArrow(features, "id string, label int, x binary").limit(2 * fit_rows).collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    if len({r["label"] for r in rows}) < 2:
        return vectors, neutral()
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(len(rows), -1)
    return vectors, fit(x, np.array([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, vectors: np.ndarray, model: Model, text_col: str = "text") -> DataFrame:
    """`row`, the columns of `docs` as a struct, and `score` (between 0 and 1, higher: label 1 likelier).

    Narrow. NULL counts as the empty text, which has zeros for features.
    """
    source = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), text_or_empty(text_col).alias("text"))
    schema = source.select("row", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                p = model.probability(pooled(part.column("text").to_pylist(), words, vectors))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(p, pa.float64())], names=["row", "score"])

    return source.mapInArrow(run, schema)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """(id, held_out, score, predicted) of every row of `docs`.

    held_out: the crc32 of the id modulo 3 is 1, so its label was not used. An empty
    table gives an empty result; without usable labels every score is 0.5.
    """
    vectors, model = train(docs, labels, id_col, text_col, fit_rows)
    scored = score(docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text")), vectors, model)
    return scored.select(
        F.col("row.id").alias("id"),
        (crc32_text(F.col("row.id")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with their columns."""
    vectors, model = train(docs, labels, id_col, text_col)
    scored = score(docs, vectors, model, text_col).filter("score >= 0.5")
    return scored.select(*[F.col("row")[c].alias(c) for c in docs.columns])
