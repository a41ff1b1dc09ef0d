"""Token ids in compressed files: a wavelet matrix for each shard.

Documents are dealt over ranges of their id and sorted inside each range, so the order
of shards is the order of documents. A task encodes its range with the tokenizers
library and closes a shard every `shard_ids` ids. A shard is one row of a Parquet file:
the lengths of its documents, one bit-plane for each bit of an id, and for each plane
the number of zeros and running counts of ones. From that row alone, single tokens,
counts of a token in a span and the places of its occurrences can be read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import latin_pattern
from .common import col, text_or_empty

# Bits between two stored counts of ones.
BLOCK = 512
SHARD_IDS = 1 << 23
MEMO_PIECES = 1_000_000
NEW_PIECES = 20_000
# Fixed value: how the word vocabulary splits lower-case text before merging.
# The endings behind the letters, which begin otherwise: most pieces are then found at the first try.
WORD_SPLIT = r"\p{L}+|\p{N}|'(?:s|t|re|ve|m|ll|d)|[^\s\p{L}\p{N}]+"


class WaveletMatrix:
    """Bit-planes of a sequence, highest bit first; each plane is ordered by the bits above,
    zeros before ones at every step."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]) -> None:
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, ranks = [], [], []
        rest = ids
        for bit in range(bits - 1, -1, -1):
            ones = rest & rest.dtype.type(1 << bit) != 0
            plane = np.packbits(ones, bitorder="little")
            left, ahead = rest[~ones], np.empty_like(rest)
            ahead[: len(left)] = left
            ahead[len(left) :] = rest[ones]
            rest = ahead
            padded = np.pad(plane, (0, -len(plane) % (BLOCK // 8))).view(np.uint64).reshape(-1, BLOCK // 64)
            counts = np.bitwise_count(padded).sum(axis=1, dtype=np.uint32)
            planes.append(plane)
            zeros.append(len(left))
            ranks.append(np.concatenate(([0], np.cumsum(counts))).astype(np.uint32))
        return cls(len(ids), planes, zeros, ranks)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for bit, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[~ones] = ids[:zeros]
            above[ones] = ids[zeros:] | kind(1 << bit)
            ids = above
        return ids

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block = i // BLOCK
        begin, end = block * BLOCK // 8, i >> 3
        total = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][begin:end]).sum())
        if i & 7:
            total += (int(self.planes[level][end]) & ((1 << (i & 7)) - 1)).bit_count()
        return total

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) zero or one of a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def access(self, i: int) -> int:
        """The token at position i."""
        token = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            token = token << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return token

    def _span(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a token in [lo, hi) lie below the last plane."""
        for level in range(len(self.planes)):
            ones_lo, ones_hi = self._ones(level, lo), self._ones(level, hi)
            if token >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + ones_lo, self.zeros[level] + ones_hi
            else:
                lo, hi = lo - ones_lo, hi - ones_hi
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions [lo, hi)."""
        if token < 0 or token >> len(self.planes):
            return 0
        begin, end = self._span(token, lo, self.n if hi is None else hi)
        return end - begin

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._span(token, 0, self.n)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._find(level, bit, i - self.zeros[level] if bit else i)
        return i


SHARD_SCHEMA = (
    "range long, part long, n long, doc_ids array<{id}>, doc_lengths array<int>, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


def matrix_of(n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]) -> WaveletMatrix:
    """The matrix of a row of a shard file."""
    return WaveletMatrix(
        n,
        [np.frombuffer(p, np.uint8) for p in planes],
        list(zeros),
        [np.frombuffer(r, np.uint32) for r in ranks],
    )


class WordEncoder:
    """Texts to ids by the tokenizers library, asking it once for each distinct piece.

    Lower-case texts of code points below 256 are cut where the vocabulary's own
    pre-tokenizer cuts them; no token crosses a cut, so pieces repeat and are remembered.
    Unknown pieces are encoded many to a call; the tokens that end a piece tell them
    apart. All other texts, and those with added tokens, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.bits = max(1, max(vocabulary.values()).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        self._find = latin_pattern(WORD_SPLIT).findall
        self._memo: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _learn(self, pieces: list[str]) -> None:
        for begin in range(0, len(pieces), NEW_PIECES):
            part = pieces[begin : begin + NEW_PIECES]
            ids = np.frombuffer(self._library([" ".join(part)])[0], self.kind)
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, size = ids.tobytes(), ids.itemsize
                cuts = [0, *(ends * size).tolist()]
                self._memo.update((piece, raw[a:b]) for piece, a, b in zip(part, cuts, cuts[1:]))
            else:
                self._memo.update(zip(part, self._library(part)))

    def __call__(self, text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return np.frombuffer(self._library([text])[0], self.kind)
        if any(name in text for name in self._added):
            return np.frombuffer(self._library([text])[0], self.kind)
        pieces = self._find(text.lower())
        found = list(map(self._memo.get, pieces))
        if None in found:
            places = [i for i, known in enumerate(found) if known is None]
            unknown = {pieces[i] for i in places}
            if len(self._memo) + len(unknown) > MEMO_PIECES:
                self._memo.clear()
            self._learn(list(unknown))
            for i in places:
                found[i] = self._memo[pieces[i]]
        return np.frombuffer(b"".join(found), self.kind)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_shards(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges: int | None = None,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Write all ids of `docs`, with `end_id` after each document, in ascending id order.

    NULL texts count as empty, NULL ids come first, and rows with one id are ordered
    by a hash of their text. `ranges` is the number of id ranges (default: the session's
    number of shuffle partitions).
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "tie", F.xxhash64("text")
    )
    dealt = source.repartitionByRange(ranges, F.col("id").asc_nulls_first(), "tie")
    dealt = dealt.sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    schema = SHARD_SCHEMA.format(id=source.schema["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number, part = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        names: list = []
        rows: list[np.ndarray] = []
        held, last = 0, np.array([end_id], encode.kind)

        def shard() -> pa.RecordBatch:
            ids = np.concatenate([x for row in rows for x in (row, last)])
            matrix = WaveletMatrix.build(ids, encode.bits)
            columns = {
                "range": [number],
                "part": [part],
                "n": [len(ids)],
                "doc_ids": pa.array([names], pa.list_(id_type)),
                "doc_lengths": pa.array([[len(r) + 1 for r in rows]], pa.list_(pa.int32())),
                "zeros": pa.array([matrix.zeros], pa.list_(pa.int64())),
                "planes": pa.array([[p.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
                "ranks": pa.array([[r.tobytes() for r in matrix.ranks]], pa.list_(pa.binary())),
            }
            return pa.RecordBatch.from_pydict(columns)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for name, text in zip(batch.column("id"), batch.column("text")):
                ids = encode(text.as_py())
                if rows and held + len(ids) + 1 > shard_ids:
                    yield shard()
                    names, rows, held, part = [], [], 0, part + 1
                names.append(name.as_py())
                rows.append(ids)
                held += len(ids) + 1
        if rows:
            yield shard()

    dealt.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of the documents in shard files.

    `start` counts the ids of all documents before. Only the sizes of shards, one
    small row for each, are put in order in one place.
    """
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()
    order = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("range", "part", "n").withColumn("offset", F.coalesce(F.sum("n").over(order), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                matrix = matrix_of(row["n"].as_py(), *(row[c].as_py() for c in ("zeros", "planes", "ranks")))
                ids = matrix.decode().astype("<u4")
                lengths = np.array(row["doc_lengths"].as_py(), np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values,
                        pa.array(starts),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                        pa.array(np.full(len(ends), row["range"].as_py())),
                        pa.array(np.full(len(ends), row["part"].as_py())),
                    ],
                    names=["id", "begin", "n_tokens", "ids_crc32", "range", "part"],
                )

    schema = f"id {id_type}, begin long, n_tokens long, ids_crc32 long, range long, part long"
    decoded = shards.select("range", "part", "n", "doc_ids", "doc_lengths", "zeros", "planes", "ranks").mapInArrow(run, schema)
    return decoded.join(offsets, ["range", "part"]).select(
        "id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
