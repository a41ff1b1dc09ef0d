"""Exact deduplication: a cuckoo-filter index of live digests.

Every row becomes (digest, id, row number), written once. Rows of one digest are
first merged within each batch of a map task, so a group of copies of any size
reaches the index as a few partial groups. The index is partitioned by digest, and
rows come to it in the order of their digests, so it closes at a border between digests
whenever it is large, and its memory does not grow with the partition. In it a cuckoo filter answers whether a digest may be live, a hit is
verified against the stored content key (SHA-256 and byte length) of its bucket,
and when a better row of the same text arrives, the live entry is deleted from
the filter and the new one inserted. A filter that overflows doubles its buckets
and is rebuilt from the stored keys.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, text_or_empty, written

SLOTS = 4
MAX_KICKS = 256
# Live keys at which an index is closed.
INDEX_KEYS = 20_000


class CuckooIndex:
    """Digest keys with values: a cuckoo filter in front of bucketed content.

    The filter holds 16-bit fingerprints, `SLOTS` to a bucket, each in one of two
    buckets. `find` reads the content only after a filter hit.
    """

    def __init__(self, buckets: int = 64) -> None:
        self.resizes = 0
        self._reset(buckets)
        self._content: dict[int, list] = {}
        self._live = 0

    def __len__(self) -> int:
        return self._live

    def _reset(self, buckets: int) -> None:
        self._buckets = buckets
        self._slots = array("H", bytes(2 * SLOTS * buckets))

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") & (self._buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return (place ^ (mark * 0x9E3779B1 >> 7)) & (self._buckets - 1)

    def _put(self, place: int, mark: int) -> bool:
        for slot in range(place * SLOTS, place * SLOTS + SLOTS):
            if not self._slots[slot]:
                self._slots[slot] = mark
                return True
        return False

    def _add_mark(self, key: bytes) -> bool:
        mark, first, second = self._places(key)
        if self._put(first, mark) or self._put(second, mark):
            return True
        place = second
        for kick in range(MAX_KICKS):
            slot = place * SLOTS + kick % SLOTS
            mark, self._slots[slot] = self._slots[slot], mark
            place = self._other(place, mark)
            if self._put(place, mark):
                return True
        return False

    def _grow(self) -> None:
        buckets = self._buckets
        while True:
            buckets *= 2
            self.resizes += 1
            self._reset(buckets)
            if all(self._add_mark(key) for held in self._content.values() for key, _ in held):
                return

    def _may_hold(self, key: bytes) -> bool:
        mark, first, second = self._places(key)
        return any(
            mark in self._slots[p * SLOTS : p * SLOTS + SLOTS] for p in (first, second)
        )

    @staticmethod
    def _bucket(key: bytes) -> int:
        return int.from_bytes(key[10:14], "little")

    def find(self, key: bytes):
        """The value of a live key, or None."""
        if self._may_hold(key):
            for stored, value in self._content.get(self._bucket(key), ()):
                if stored == key:
                    return value
        return None

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not live."""
        self._content.setdefault(self._bucket(key), []).append((key, value))
        self._live += 1
        if not self._add_mark(key):
            self._grow()

    def delete(self, key: bytes) -> None:
        """Remove a live key: one of its marks and its stored content."""
        bucket = self._bucket(key)
        rest = [entry for entry in self._content[bucket] if entry[0] != key]
        if rest:
            self._content[bucket] = rest
        else:
            del self._content[bucket]
        self._live -= 1
        mark, first, second = self._places(key)
        for place in (first, second):
            for slot in range(place * SLOTS, place * SLOTS + SLOTS):
                if self._slots[slot] == mark:
                    self._slots[slot] = 0
                    return

    def items(self) -> Iterator[tuple[bytes, object]]:
        for held in self._content.values():
            yield from held


def _merge(index: CuckooIndex, key: bytes, keep, row: int, size: int) -> None:
    """Let the larger (id, earlier row) of two holders of a text stay live."""
    live = index.find(key)
    if live is None:
        index.insert(key, (keep, row, size))
        return
    kept, kept_row, count = live
    larger = keep is not None and (kept is None or keep > kept)
    if larger or (keep == kept and row < kept_row):
        kept, kept_row = keep, row
    index.delete(key)
    index.insert(key, (kept, kept_row, count + size))


def _indexed(ordered: bool, smallest: int, keys: int = INDEX_KEYS):
    """Fold rows (key, keep, keep_row, size) through indexes of about `keys` live keys.

    Rows ordered by key give one entry a key; others one a key and index.
    """

    def flush(index: CuckooIndex, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        entries = [(k, *v) for k, v in index.items() if v[2] >= smallest]
        if entries:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*entries), schema)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, schema, last = CuckooIndex(), None, None
        for batch in batches:
            schema = batch.schema
            for entry in zip(*(c.to_pylist() for c in batch.columns)):
                if len(index) >= keys and not (ordered and entry[0] == last):
                    yield from flush(index, schema)
                    index = CuckooIndex()
                last = entry[0]
                _merge(index, *entry)
        if schema is not None:
            yield from flush(index, schema)

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    index_keys: int = INDEX_KEYS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, row.

    `row` holds the columns named in `carry` as a struct. Texts are equal when
    identical; NULL counts as the empty text. The row with the largest id stays;
    a NULL id is smaller than any other, and of repeated rows with one id a single
    one stays. An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    rows = written(
        docs.select(
            F.concat(
                F.unhex(F.sha2(text, 256)), F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
            ).alias("key"),
            col(id_col).alias("id"),
            F.monotonically_increasing_id().alias("number"),
            F.struct(F.lit(0).alias("_"), *[col(c) for c in carry]).alias("row"),
        )
    )
    entries = rows.select(
        "key", F.col("id").alias("keep"), F.col("number").alias("keep_row"), F.lit(1).cast("long").alias("size")
    )
    partial = entries.mapInArrow(_indexed(ordered=False, smallest=1, keys=index_keys), entries.schema)
    by_key = partial.repartition("key").sortWithinPartitions("key")
    groups = by_key.mapInArrow(_indexed(ordered=True, smallest=2, keys=index_keys), entries.schema)
    return rows.join(groups, "key", "left").select(
        "id",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("number") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"),
        "row",
    )


def keep_one_of_equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    rows = exact_dedup(docs, id_col, text_col, carry=docs.columns)
    return rows.filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
