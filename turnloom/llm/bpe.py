"""Byte-level BPE encoding and decoding with a segment tree over adjacent pairs.

A piece of text is a row of symbols; each adjacent pair that a merge rule covers
has that rule's rank. The leaves of a segment tree hold (rank, position), inner
nodes the smaller of their children, so the root is the leftmost pair of lowest
rank. Merging it changes three leaves, each updated in logarithmic time, until the
root holds no mergeable pair.

Pieces repeat, so each distinct piece of a batch of texts is merged once, and the trees
of all short pieces are kept as rows of one array and stepped together; a long piece
has a tree of its own. Both forms apply the same rule.

The vocabulary is a tokenizers JSON file, read by each Python worker from its path.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, pieces, text_or_empty

NO_PAIR = 1 << 62
POSITION_BITS = 32
SYMBOL_BITS = 20
# Pieces remembered by one worker; a full memory starts anew. Encodings do not depend on it.
MEMO_PIECES = 500_000
# Pieces of up to so many symbols are merged side by side.
ROW_SYMBOLS = 64
TEXT_BYTES = 1 << 22
# Rows merged together; a few thousand trees fit a processor's cache.
ROWS_AT_ONCE = 4_000
# Fixed value: how byte-level vocabularies split text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable
    Latin-1 other than a space, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, free = [], 256
    for byte in range(256):
        names.append(chr(byte) if byte in plain else chr(free))
        free += byte not in plain
    return names


def latin_pattern(split: str = SPLIT) -> re.Pattern:
    """A split rule spelled out for texts of code points below 256, for the faster standard engine."""
    members = {"L": "", "N": "", "s": ""}
    for char in map(chr, range(256)):
        kind = "s" if regex.match(r"\s", char) else unicodedata.category(char)[0]
        if kind in members:
            members[kind] += f"\\x{ord(char):02x}"
    spelled = split.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(members.values())}]")
    spelled = spelled.replace(r"\p{L}", f"[{members['L']}]").replace(r"\p{N}", f"[{members['N']}]")
    return re.compile(spelled.replace(r"\S", f"[^{members['s']}]").replace(r"\s", f"[{members['s']}]"))


def merge_symbols(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Apply merges, lowest rank first and leftmost first, until none is left.

    `ranks` maps (left << SYMBOL_BITS | right) to a rank, `merged` a rank to a symbol.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = symbols[:]
    rank_of = ranks.get
    width = 1 << (n - 2).bit_length()
    tree = [NO_PAIR] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(symbols[i] << SYMBOL_BITS | symbols[i + 1])
        if rank is not None:
            tree[width + i] = rank << POSITION_BITS | i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def update(leaf: int, value: int) -> None:
        node = width + leaf
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    while tree[1] != NO_PAIR:
        at = tree[1] & ((1 << POSITION_BITS) - 1)
        symbol = symbols[at] = merged[tree[1] >> POSITION_BITS]
        gone = after[at]
        follower = after[at] = after[gone]
        symbols[gone] = -1
        if gone < n - 1:
            update(gone, NO_PAIR)
        rank = None
        if follower < n:
            before[follower] = at
            rank = rank_of(symbol << SYMBOL_BITS | symbols[follower])
        update(at, NO_PAIR if rank is None else rank << POSITION_BITS | at)
        leader = before[at]
        if leader >= 0:
            rank = rank_of(symbols[leader] << SYMBOL_BITS | symbol)
            update(leader, NO_PAIR if rank is None else rank << POSITION_BITS | leader)
    return [s for s in symbols if s >= 0]


class PairRanks:
    """Merge rules: ranks of symbol pairs, and the symbol each merge makes."""

    def __init__(self, rules: list[tuple[int, int, int]]) -> None:
        self.ranks: dict[int, int] = {}
        for rank, (left, right, _) in enumerate(rules):
            self.ranks.setdefault(left << SYMBOL_BITS | right, rank)
        self.merged = [made for _, _, made in rules]
        self._made = np.array([*self.merged, 0], np.int64)
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], NO_PAIR)
        self._ranks = np.append(np.fromiter(self.ranks.values(), np.int64, len(self.ranks))[order], 0)

    def leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Leaf values of symbol pairs; a negative symbol is none."""
        keys = left << SYMBOL_BITS | right
        at = np.searchsorted(self._keys, keys)
        known = (self._keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self._ranks[at] << POSITION_BITS | position, NO_PAIR)

    def merge_rows(self, lengths: np.ndarray, flat: np.ndarray) -> list[tuple[int, ...]]:
        """`merge_symbols` of many short rows, given end to end; one tree to an array row."""
        rows, longest = len(lengths), max(2, int(lengths.max()))
        symbols = np.full((rows, longest + 1), -1, np.int64)
        symbols[np.arange(longest + 1) < lengths[:, None]] = flat
        width = 1 << (longest - 2).bit_length()
        tree = np.full((rows, 2 * width), NO_PAIR, np.int64)
        tree[:, width : width + longest] = self.leaves(
            symbols[:, :-1], symbols[:, 1:], np.arange(longest)
        )[:, :width]
        half = width
        while half > 1:
            tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
            half //= 2
        after = np.tile(np.arange(1, longest + 2), (rows, 1))
        before = np.tile(np.arange(-1, longest), (rows, 1))
        live = np.flatnonzero(tree[:, 1] != NO_PAIR)
        while len(live):
            root = tree[live, 1]
            at = root & ((1 << POSITION_BITS) - 1)
            symbol = self._made[root >> POSITION_BITS]
            gone = after[live, at]
            follower = after[live, gone]
            symbols[live, at] = symbol
            symbols[live, gone] = -1
            follower = np.minimum(follower, longest)
            after[live, at] = follower
            before[live, follower] = at
            leader = before[live, at]
            led, inner = leader >= 0, gone < width
            row = np.concatenate([live[inner], live, live[led]])
            leaf = np.concatenate([gone[inner], at, leader[led]])
            value = np.concatenate(
                [
                    np.full(int(inner.sum()), NO_PAIR),
                    self.leaves(symbol, symbols[live, follower], at),
                    self.leaves(symbols[live[led], leader[led]], symbol[led], leader[led]),
                ]
            )
            fits = leaf < width  # the last symbol of the longest rows leads no pair
            row, node = row[fits], leaf[fits] + width
            tree[row, node] = value[fits]
            while node[0] > 1:
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            live = live[tree[live, 1] != NO_PAIR]
        kept = symbols >= 0
        flat = symbols[kept].tolist()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends)]


class BytePairCodec:
    """Text to ids and back under one byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        names = byte_symbols()
        byte_of = {name: byte for byte, name in enumerate(names)}
        self._byte_ids = np.array([vocabulary[name] for name in names])
        pairs = (p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"])
        self._rules = PairRanks([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._bytes = {i: bytes(byte_of[c] for c in name) for name, i in vocabulary.items()}
        self._bytes |= {i: name.encode() for name, i in self._special.items()}
        longest = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._at_special = re.compile("(" + "|".join(longest) + ")") if longest else None
        self._find_latin, self._find_any = latin_pattern().findall, regex.compile(SPLIT).findall
        # Pieces and added tokens to ids. An added token is never a piece: pieces do not hold it whole.
        self._memo: dict[object, tuple[int, ...]] = {}

    def _learn(self, unknown: list[str]) -> None:
        """Merge pieces, those of like length side by side."""
        encoded = [piece.encode("utf-8") for piece in unknown]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        order = np.argsort(lengths, kind="stable")
        short = int((lengths <= ROW_SYMBOLS).sum())
        for begin in range(0, short, ROWS_AT_ONCE):
            chosen = order[begin : min(begin + ROWS_AT_ONCE, short)]
            joined = b"".join([encoded[i] for i in chosen])
            flat = self._byte_ids[np.frombuffer(joined, np.uint8)]
            merged = self._rules.merge_rows(lengths[chosen], flat)
            self._memo.update(zip([unknown[i] for i in chosen], merged))
        for i in order[short:]:
            symbols = self._byte_ids[np.frombuffer(encoded[i], np.uint8)].tolist()
            self._memo[unknown[i]] = tuple(merge_symbols(symbols, self._rules.ranks, self._rules.merged))

    def _find(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._find_any(text)
        return self._find_latin(text)

    def _split(self, text: str) -> list:
        if not self._at_special:
            return self._find(text)
        parts = self._at_special.split(text)
        found = self._find(parts[0])
        for i in range(1, len(parts), 2):
            found.append((self._special[parts[i]],))
            found.extend(self._find(parts[i + 1]))
        return found

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; the strings of added tokens become those tokens."""
        split = [self._split(text) for text in texts]
        unknown = set().union(*split).difference(self._memo)
        for token in [x for x in unknown if isinstance(x, tuple)]:
            unknown.remove(token)
            self._memo[token] = token
        if len(self._memo) + len(unknown) > MEMO_PIECES:
            self._memo = {x: x if isinstance(x, tuple) else None for x in set().union(*split)}
            unknown = [x for x, ids in self._memo.items() if ids is None]
        self._learn(list(unknown))
        ids_of = self._memo.__getitem__
        return [list(chain.from_iterable(map(ids_of, found))) for found in split]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that form no character become U+FFFD."""
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")

    def id_texts(self) -> list[str]:
        return [str(i) for i in range(max(self._bytes) + 1)]


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """One codec for each worker and vocabulary; workers are reused between tasks.

    It holds many small tuples and no cycles, which the cycle collector would
    otherwise visit again and again.
    """
    gc.disable()
    return BytePairCodec(path)


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, input_ids): whole texts as arrays of ids; NULL counts as the empty text.

    Narrow: one row out for each row in, repeated rows and NULL ids included.
    """
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = source.select("id", F.array(F.lit(0)).alias("input_ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_batch = codec(vocabulary).encode_batch
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                rows = [np.array(ids, np.int32) for ids in encode_batch(part.column("text").to_pylist())]
                bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int32)))
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], names=["id", "input_ids"])

    return source.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(id, text) from (id, input_ids); a NULL list counts as empty."""
    source = encoded.select("id", "input_ids")
    schema = source.select("id", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(vocabulary).decode
        for batch in batches:
            texts = [decode(ids.as_py() or ()) for ids in batch.column("input_ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return source.mapInArrow(run, schema)


def round_trip_digests(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded, in one task.

    The digests are of the decimal ids joined by commas and of the decoded text in UTF-8.
    """
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    fields = (F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256"))
    schema = source.select("id", *fields).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = codec(vocabulary)
        written_as = pairs.id_texts().__getitem__
        for part in (p for batch in batches for p in pieces(batch, "text", TEXT_BYTES)):
            counts, ids_digests, text_digests = [], [], []
            for ids in pairs.encode_batch(part.column("text").to_pylist()):
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(",".join(map(written_as, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(run, schema)
