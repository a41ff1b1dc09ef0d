"""Near-duplicates by SimHash: a self-join of binary tries with a Hamming budget.

Two fingerprints that differ in at most `budget` bits agree in at least
`blocks - budget` of `blocks` blocks. So for every choice of that many blocks the
chosen ones lead the bit order, and the fingerprints with the same leading bits
form one binary trie. A pair within the budget meets in one trie at least.

Each trie is joined with itself by walking node pairs together: a pair of nodes
splits into the pairs of their children, a differing child bit adds one to the
error of the pair, and a pair over the budget is dropped with all below it. What
is found becomes links to the smallest member of a local group, not all pairs, and
node pairs whose leaves already share a group are skipped. Components of the links
come from repeated star contractions as Spark jobs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import col, text_or_empty, without_ids, written

BITS = 64
HASH_SEED = 42
CHUNK = 1 << 14
FRONTIER = 1 << 18


def fingerprint(text: str, shingle_words: int) -> int:
    """Bitwise majority of the XXH64 values of the word shingles, repeats included."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(HASH_SEED)), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), CHUNK):
        part = hashes[begin : begin + CHUNK].view(np.uint8)
        bits = np.unpackbits(part, bitorder="little").reshape(-1, BITS)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, fp): the fingerprint as a signed long; NULL counts as the empty text."""
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = source.select("id", F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            fps = np.fromiter(
                (fingerprint(texts[i].as_py(), shingle_words) for i in range(len(texts))), np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"]
            )

    return source.mapInArrow(run, schema)


class Groups:
    """Union of positions 0..n-1; `label` is the smallest position of each group."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.label[a], self.label[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.label, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def trie_groups(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int, budget: int) -> np.ndarray:
    """Group labels of sorted unsigned keys under links within the budget.

    [starts, ends) are the tries: runs of keys with the same `lead` leading bits.
    Sorted neighbours are tried first, which lets dense groups be skipped early;
    the walk below then finds every remaining pair.
    """
    groups = Groups(len(keys))
    trie = np.repeat(np.arange(len(starts)), ends - starts)
    for step in (1, 2):
        a = np.flatnonzero(trie[:-step] == trie[step:]) if len(keys) > step else np.empty(0, np.int64)
        near = _distance(keys[a], keys[a + step]) <= budget
        groups.unite(a[near], a[near] + step)
    ones: dict[int, np.ndarray] = {}

    def prefix(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        return ones[bit]

    several = ends - starts > 1
    first = np.stack([starts[several], ends[several], starts[several], ends[several]])
    stack = [(BITS - lead - 1, first, np.zeros(first.shape[1], np.int64))]
    while stack:
        bit, pairs, errors = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack.append((bit, pairs[:, half:], errors[half:]))
            stack.append((bit, pairs[:, :half], errors[:half]))
            continue
        lo, hi, other_lo, other_hi = pairs
        changes = np.concatenate(([0], np.cumsum(groups.label[1:] != groups.label[:-1])))
        done = (
            (changes[hi - 1] == changes[lo])
            & (changes[other_hi - 1] == changes[other_lo])
            & (groups.label[lo] == groups.label[other_lo])
        )
        pairs, errors = pairs[:, ~done], errors[~done]
        single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
        a, b = pairs[0, single], pairs[2, single]
        near = _distance(keys[a], keys[b]) <= budget
        groups.unite(a[near], b[near])
        pairs, errors = pairs[:, ~single], errors[~single]
        if not pairs.shape[1] or bit < 0:
            continue
        lo, hi, other_lo, other_hi = pairs
        count = prefix(bit)
        mid = hi - (count[hi] - count[lo])
        other_mid = other_hi - (count[other_hi] - count[other_lo])
        crossing = lo != other_lo  # a node paired with itself has one mixed pair of children, not two
        children = np.concatenate(
            [
                np.stack([lo, mid, other_lo, other_mid]),
                np.stack([mid, hi, other_mid, other_hi]),
                np.stack([lo, mid, other_mid, other_hi]),
                np.stack([mid, hi, other_lo, other_mid])[:, crossing],
            ],
            axis=1,
        )
        error = np.concatenate([errors, errors, errors + 1, errors[crossing] + 1])
        alone = (children[0] == children[2]) & (children[1] - children[0] == 1)
        live = (children[0] < children[1]) & (children[2] < children[3]) & (error <= budget) & ~alone
        stack.append((bit - 1, children[:, live], error[live]))
    return groups.label


def _walk(lead: int, budget: int):
    """Sorted rows (choice, key, fp) to links (a, b) between fingerprints."""

    def links(choice: np.ndarray, keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        head = keys >> np.uint64(BITS - lead)
        new = np.flatnonzero((head[1:] != head[:-1]) | (choice[1:] != choice[:-1])) + 1
        starts = np.concatenate(([0], new))
        ends = np.concatenate((new, [len(keys)]))
        label = trie_groups(keys, starts, ends, lead, budget)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[linked]), pa.array(fps[label[linked]])], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int32), np.empty(0, np.uint64), np.empty(0, np.int64)]
        for batch in batches:
            arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            arrays[1] = arrays[1].view(np.uint64)
            held = [np.concatenate(pair) for pair in zip(held, arrays)]
            if len(held[0]) < 50_000:
                continue
            head = held[1] >> np.uint64(BITS - lead)
            last = np.flatnonzero((head != head[-1]) | (held[0] != held[0][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield links(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield links(*held)

    return run


def _moved(fp: Column, chosen: tuple[int, ...], bounds: list[int]) -> tuple[Column, int]:
    """The fingerprint with the chosen blocks moved to the front; their total width."""
    order = [*chosen, *(i for i in range(len(bounds) - 1) if i not in chosen)]
    out, top = F.lit(0).cast("long"), BITS
    for i in order:
        width = bounds[i + 1] - bounds[i]
        top -= width
        part = F.shiftrightunsigned(fp, bounds[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(part, top))
    return out, sum(bounds[i + 1] - bounds[i] for i in chosen)


def similar_links(unique: DataFrame, budget: int, blocks: int) -> DataFrame:
    """Links (a, b) that join every two fingerprints of `unique` within the budget."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    moved = [_moved(F.col("fp"), c, bounds) for c in combinations(range(blocks), blocks - budget)]
    lead = min(width for _, width in moved)
    keyed = unique.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("choice"), key.alias("key")) for i, (key, _) in enumerate(moved)])
        ).alias("k"),
    ).select("k.choice", "k.key", "fp")
    placed = keyed.repartition("choice", F.shiftrightunsigned("key", BITS - lead))
    return placed.sortWithinPartitions("choice", "key").mapInArrow(_walk(lead, budget), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node except the roots: star contractions to a fixed point.

    One round hangs each node's larger neighbours on its smallest one (large star),
    then its smaller neighbours and itself on that (small star). The rounds needed
    grow with the logarithm of the longest chain. All work is joins and minima.
    """

    def larger_first(df: DataFrame) -> DataFrame:
        pairs = df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return written(pairs.distinct())

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = larger_first(links)
    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = larger_first(large)
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = larger_first(small.union(least.select("a", F.col("m").alias("b"))))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def blocks_for(n: int, budget: int) -> int:
    """More blocks, hence longer exact prefixes and smaller tries, for more fingerprints.

    Any choice gives the same links; this one only sets how the work is dealt.
    """
    return budget + (1 if n < 50_000_000 else 2 if n < 10_000_000_000 else 3)


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 4,
    budget: int = 4,
) -> DataFrame:
    """One row per input row: id, fp (signed long), component_id.

    component_id is the smallest id reachable over links of at most `budget`
    differing bits. NULL texts count as empty; texts without words have the
    fingerprint zero and link like any other. NULL ids are ignored in the minimum;
    a component of NULL ids only has a NULL id. Repeated rows share a fingerprint.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle_words))
    unique = written(rows.groupBy("fp").agg(F.min("id").alias("least_id"), F.count("*").alias("n")))
    root_of = components(similar_links(unique, budget, blocks_for(unique.count(), budget)))
    rooted = unique.join(root_of, unique["fp"] == root_of["node"], "left").select(
        "fp", "least_id", "n", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(
        F.min("least_id").alias("component_id"), F.sum("n").alias("members")
    )
    named = written(
        rooted.join(least.filter("members > 1"), "root").select("fp", "component_id", F.lit(True).alias("shared"))
    )
    return rows.join(named, "fp", "left").select(
        "id", "fp", F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def keep_one_of_each_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose id is not the smallest of its component.

    Rows without an id cannot be told apart by it and stay.
    """
    rows = simhash_components(docs, id_col, text_col)
    return without_ids(docs, id_col, rows.filter("id <> component_id"))
