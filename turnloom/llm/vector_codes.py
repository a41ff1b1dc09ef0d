"""Product codes of whole-number vectors, assigned exactly with LAESA pivots.

Vectors are cut into equal parts; each part position has a codebook of at most 256 entries,
refined in rounds: every part goes to its nearest entry, and every entry becomes the floor of
the mean of its parts. Some entries of each first codebook, far from each other, stay as
pivots. The distances of all parts to them are computed once and stored with the parts. In a
round only the pivots' distances to the current entries are new: by the triangle inequality
the greatest difference of the two is a lower bound on the distance of part and entry. Entries
are tried in the order of their bounds, in whole numbers, and a part is done as soon as the
next bound is above the best distance found. So results are those of trying all entries.

The codebooks hold at most 256 vectors, so they travel with the tasks. Sums and counts of a
round are made per task and added by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
ROWS = 2048
# Whole numbers up to here are exact as doubles.
LARGEST = 1 << 53
# Relative slack of bounds in floating point; far above the rounding of a difference of roots.
SLACK = 1e-9


@dataclass
class Codebook:
    """One part position: the current entries (whole numbers) and the fixed pivots."""

    entries: np.ndarray
    pivots: np.ndarray


def _numbers(values: np.ndarray) -> np.ndarray:
    """The values in a type in which squared distances cannot overflow."""
    largest = max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0
    wide = 4 * largest * largest * max(1, values.shape[-1]) >= 1 << 62
    return values.astype(object) if wide else values


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, in whole numbers."""
    d = a - b
    return (d * d).sum(axis=-1)


def roots(values: np.ndarray) -> np.ndarray:
    return np.sqrt(values.astype(np.float64))


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the entries: the first, then always the one farthest from those chosen."""
    chosen = [0]
    nearest = squared(entries, entries[0])
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def to_pivots(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (rows, pivots)."""
    return np.stack([roots(squared(parts, p)) for p in pivots], axis=1)


def nearest(
    parts: np.ndarray, near: np.ndarray, book: Codebook
) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry (of ties the first) and squared distance of every part.

    `near` holds the parts' distances to the pivots. Also tells how many distances of parts
    and entries were evaluated.
    """
    parts, entries = _numbers(parts), _numbers(book.entries)
    if parts.dtype != entries.dtype:
        parts, entries = parts.astype(object), entries.astype(object)
    of_entries = to_pivots(entries, _numbers(book.pivots).astype(entries.dtype))
    bound = np.zeros((len(parts), len(entries)))
    for p in range(of_entries.shape[1]):
        np.maximum(bound, np.abs(near[:, p, None] - of_entries[None, :, p]), out=bound)
    bound -= SLACK * (near.max(axis=1)[:, None] + of_entries.max())
    order = np.argsort(bound, axis=1, kind="stable")
    best_entry = order[:, 0].copy()
    best = squared(parts, entries[best_entry])
    evaluated, open_rows = len(parts), np.arange(len(parts))
    for step in range(1, len(entries)):
        tried = order[open_rows, step]
        possible = bound[open_rows, tried] <= roots(best[open_rows]) * (1 + SLACK)
        open_rows, tried = open_rows[possible], tried[possible]
        if not len(open_rows):
            break
        found = squared(parts[open_rows], entries[tried])
        evaluated += len(open_rows)
        held = best[open_rows]
        better = (found < held) | ((found == held) & (tried < best_entry[open_rows]))
        best[open_rows[better]], best_entry[open_rows[better]] = found[better], tried[better]
    return best_entry, best, evaluated


def _vectors(batch: pa.RecordBatch, books: list[Codebook]) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """(first row, parts by position, pivot distances by position) of slices of a batch."""
    width, pivots = len(books[0].pivots[0]), len(books[0].pivots)
    for begin in range(0, batch.num_rows, ROWS):
        some = batch.slice(begin, ROWS)
        v = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, len(books), width)
        near = some.column("near").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, len(books), pivots)
        yield begin, [v[:, i] for i in range(len(books))], [near[:, i] for i in range(len(books))]


def _measure(pivots: list[np.ndarray]) -> Callable:
    """Rows with the column `near`: distances of all parts to their pivots, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, n = len(pivots[0][0]), len(pivots[0])
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(pivots), width)
            near = np.empty((batch.num_rows, len(pivots), n))
            for i, fixed in enumerate(pivots):
                parts, at = _numbers(v[:, i]), _numbers(fixed)
                if parts.dtype != at.dtype:
                    parts, at = parts.astype(object), at.astype(object)
                near[:, i] = to_pivots(parts, at)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (n * len(pivots)))
            column = pa.ListArray.from_arrays(ends, pa.array(near.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "near"])

    return run


def _gather(books: list[Codebook]) -> Callable:
    """Rows to (part, entry, place, total, n): sums and counts of the parts of each entry, by task."""
    width = len(books[0].entries[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b.entries), width), object) for b in books]
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        for batch in batches:
            for _, parts, near in _vectors(batch, books):
                for i, book in enumerate(books):
                    entry, _, _ = nearest(parts[i], near[i], book)
                    counts[i] += np.bincount(entry, minlength=len(counts[i]))
                    # Halves of the numbers, so that a slice's sums fit in whole 64-bit numbers.
                    high, low = parts[i] >> 32, parts[i] & 0xFFFFFFFF
                    for half, shift in ((high, 32), (low, 0)):
                        added = np.zeros((len(counts[i]), width), np.int64)
                        np.add.at(added, entry, half)
                        totals[i] += added.astype(object) << shift
        for i, book in enumerate(books):
            used = np.flatnonzero(counts[i])
            if len(used):
                rows = len(used) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, i, np.int32)),
                        pa.array(np.repeat(used, width).astype(np.int32)),
                        pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                        pa.array([str(x) for x in totals[i][used].reshape(-1)]),
                        pa.array(np.repeat(counts[i][used], width)),
                    ],
                    names=["part", "entry", "place", "total", "n"],
                )

    return run


def _assign(books: list[Codebook]) -> Callable:
    """Rows to (id, label, entries, error as text, evaluated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = np.empty((batch.num_rows, len(books)), np.int32)
            error = np.zeros(batch.num_rows, object)
            evaluated = np.zeros(batch.num_rows, np.int64)
            for begin, parts, near in _vectors(batch, books):
                rows = slice(begin, begin + len(parts[0]))
                for i, book in enumerate(books):
                    entries[rows, i], found, tried = nearest(parts[i], near[i], book)
                    error[rows] += found
                    evaluated[begin] += tried
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(books))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.ListArray.from_arrays(ends, pa.array(entries.reshape(-1))),
                    pa.array([str(x) for x in error]),
                    pa.array(evaluated),
                ],
                names=["id", "label", "entries", "error", "evaluated"],
            )

    return run


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """(id, label, v): vectors of whole numbers, those that cannot be coded left out."""
    given = col(vector_col).cast("array<double>")
    scaled = F.transform(given, lambda x: F.floor(x * SCALE))
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / SCALE))
    usable = F.coalesce(finite & (F.size(given) > 0) & (F.size(given) % parts == 0), F.lit(False))
    kept = vectors.filter(usable).select(col(id_col).alias("id"), col(label_col).alias("label"), scaled.alias("v"))
    return kept


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, entries array<int>, error long, evaluated long), and the final codebooks.

    Left out are vectors that are NULL, empty, hold NULL or non-finite components or components
    of 2^43 and more, or whose length differs from that of the first vector (by id, NULL ids
    last) or cannot be cut into equal parts. The first codebooks are the parts of the vectors
    of the smallest ids; among repeated ids the smaller vector comes first, and NULL ids come
    last. Fewer vectors give fewer entries; without any, the result is empty. `evaluated`
    sums up, in some row of each slice, the distances computed for it. An error that does not
    fit in a long is NULL.
    """
    kept = whole_vectors(vectors, id_col, vector_col, label_col, parts)
    by_id = [F.col("id").asc_nulls_last(), F.col("v")]
    first = kept.orderBy(*by_id).select(F.size("v").alias("n")).first()
    if first is None:
        schema = "entries array<int>, error bigint, evaluated bigint"
        empty = kept.limit(0).select("id", "label", F.from_json(F.lit("{}"), schema).alias("s"))
        return empty.select("id", "label", "s.*"), []
    kept = kept.filter(F.size("v") == first["n"])
    width = first["n"] // parts
    start = np.array([r["v"] for r in kept.orderBy(*by_id).limit(entries).collect()], np.int64)
    books = []
    for i in range(parts):
        part = _numbers(start[:, i * width : (i + 1) * width])
        books.append(Codebook(part.astype(np.int64), far_apart(part, pivots).astype(np.int64)))
    near = F.lit(None).cast("array<double>").alias("near")
    stored = written(kept.mapInArrow(_measure([b.pivots for b in books]), kept.select("*", near).schema))
    for _ in range(rounds):
        sums = (
            stored.select("v", "near")
            .mapInArrow(_gather(books), "part int, entry int, place int, total string, n bigint")
            .groupBy("part", "entry", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        )
        # At most one row for each component of the codebooks.
        for part, entry, place, total, n in sums.collect():
            books[part].entries[entry, place] = int(total) // n
    out = stored.mapInArrow(
        _assign(books), stored.select("id", "label", F.lit(None).cast("array<int>").alias("entries"), F.lit("").alias("error"), F.lit(0).cast("long").alias("evaluated")).schema
    )
    error = F.col("error").cast("decimal(38,0)").try_cast("long")
    return out.withColumn("error", error), [b.entries for b in books]


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Add `label_error`: the error summed over rows of the same label, NULL labels together.

    Sums are made before the shuffle; their few rows are joined back, so a frequent label
    does not meet in one task. NULL where the sum does not fit in a long.
    """
    same = F.struct("label")
    sums = codes.groupBy(same.alias("_same")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return codes.withColumn("_same", same).join(sums, "_same", "left").drop("_same")
