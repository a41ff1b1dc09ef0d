"""Exact similarity join of documents on their sets of word shingles (Jaccard).

Candidates. Sets are ordered by 64-bit shingle hash. Two sets that link have at least
ceil(s * n) shingles in common, n being the larger size, so by the usual prefix argument the
first `n - ceil(s * n) + m` shingles of each hold at least the first m common ones. m grows
with the size (`EXTRA` per cent of it), so a set links with nothing unless that many of its
prefix shingles occur in other sets; most sets, those that share a passage or a line with
thousands of others included, end here. Of the rest, the m - 1 most frequent shared shingles
can be left out again, and the sets that share one of the others are connected.

Tiles. Each connected cluster of candidates is dealt into size bands and, inside a band, into
blocks of a bounded number of shingles. A tile is a block with itself, then two blocks of the
same or of neighbouring bands; other sizes cannot link. In a tile every set has a bitmap of
hashed shingles, as wide as its band asks for, that flips a bit for each. Two sets differ in
at least as many shingles as their bitmaps in bits, which bounds the overlap from above; only
pairs that this leaves are compared, shingle array with shingle array. A tile gives links to
the smallest member of each group, not all pairs; sets that earlier tiles put into one
component are not compared again, and tiles of a single component are not even made. So a
large group of near copies costs about as many comparisons as it has members.

Components come from the star contractions of `simhash_dedup`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import col, computed, pieces, text_or_empty, written
from .simhash_dedup import Groups, components

SHINGLE_WORDS = 5
PER_CENT = 80
# Extra prefix, in per cent of a set; it decides how much a set must share to be a candidate.
EXTRA = 10
# Shingles in a block; a tile has two blocks at most. A set counts as SMALLEST shingles at least,
# which bounds the sets of a block as well.
BLOCK = 1 << 22
SMALLEST = 128
BATCH_BYTES = 4 << 20
WORD_CACHE = 1 << 20
SEED = 13


class WordHashes(dict):
    """Hashes of words; forgets all when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxh64_intdigest(word, SEED)
        return value


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, size: int, known: WordHashes) -> np.ndarray:
    """Ascending distinct hashes of the word shingles; fewer words are one shingle, none is none."""
    words = text.encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    span = min(size, n)
    out = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        out = out * _STEP + hashed[k : n - span + 1 + k]
    return np.unique(_spread(out))


def least_common(n: int, per_cent: int) -> int:
    """Shingles that a set of n has in common with any set that it links with."""
    return -(-n * per_cent // 100)


def prefix_length(n: int, per_cent: int) -> int:
    return min(n, n - least_common(n, per_cent) + 1 + n * EXTRA // 100)


def spare(n: Column, per_cent: int) -> Column:
    """How many of its shared prefix shingles a set can leave out: less than any partner shares."""
    least_partner = F.ceil(n * per_cent / 100)
    return F.floor(least_partner * EXTRA / 100)


def _key(hashes: np.ndarray) -> int:
    """The set's own 64-bit digest, signed."""
    value = xxh64_intdigest(hashes.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def _sets(size: int):
    """Batches with a column `text` to (batch, [shingle sets])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        known = WordHashes()
        for batch in batches:
            for part in pieces(batch, "text", BATCH_BYTES):
                texts = part.column("text")
                yield part, [shingle_set(texts[i].as_py(), size, known) for i in range(len(texts))]

    return run


def sized(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, text_key, key, n): the digest and the number of shingles of each document."""
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    schema = source.select("id", "text_key", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("n")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(size)(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("text_key"),
                    pa.array([_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                names=["id", "text_key", "key", "n"],
            )

    return source.mapInArrow(run, schema)


def prefixes(docs: DataFrame, text_col: str, size: int, per_cent: int) -> DataFrame:
    """(h, key): the prefix shingles of each set; equal sets of one batch give theirs once."""
    source = docs.select(text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _sets(size)(batches):
            hs, keys = [], []
            for s in sets:
                key = _key(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    hs.append(s[: prefix_length(len(s), per_cent)])
                    keys.append(np.full(len(hs[-1]), key, np.int64))
            if len(seen) > 1 << 18:
                seen.clear()
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(keys))], names=["h", "key"]
                )

    return source.mapInArrow(run, "h long, key long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, key): distinct ones whose h has another key. Holds one row back, no group."""
    last_h = last_key = None  # the last distinct row
    waiting = False  # whether it is the first of its h, so that nothing is known yet
    for batch in batches:
        h, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if last_h is not None:
            h, key = np.concatenate(([last_h], h)), np.concatenate(([last_key], key))
        new_h = np.concatenate(([True], h[1:] != h[:-1]))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (key[1:] != key[:-1])))
        h, key, new_h = h[new], key[new], new_h[new]
        if last_h is not None:
            new_h[0] = waiting
        begun_before = last_h is not None
        follows = np.concatenate((~new_h[1:], [False]))
        out = ~new_h | follows
        if begun_before and not waiting:
            out[0] = False  # it was given already
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(h[out]), pa.array(key[out])], names=["h", "key"])
        last_h, last_key, waiting = h[-1], key[-1], bool(new_h[-1] and not out[-1])


def candidate_clusters(docs: DataFrame, sets: DataFrame, text_col: str, size: int, per_cent: int) -> DataFrame:
    """(key, cluster): sets that may link with others; sets that link are in one cluster."""
    rows = prefixes(docs, text_col, size, per_cent).repartition("h").sortWithinPartitions("h", "key")
    shared = rows.mapInArrow(_shared, "h long, key long")
    given_up = spare(F.col("n"), per_cent)
    counted = shared.groupBy("key").agg(F.collect_list("h").alias("hs"))
    some = written(
        counted.join(sets.select("key", "n"), "key").filter(F.size("hs") > given_up).select("key", "n", "hs")
    )
    # Shingles that candidates share, and how many of them do.
    each = some.select("key", "n", F.explode("hs").alias("h"))
    frequent = each.groupBy("h").agg(F.count("*").alias("df"), F.min("key").alias("first")).filter("df > 1")
    listed = each.join(frequent, "h").groupBy("key", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "h", "first"))).alias("hs")
    )
    spared = computed(listed, kept=F.slice("hs", 1, F.greatest(F.size("hs") - given_up, F.lit(0)).cast("int")))
    links = spared.select(F.col("key").alias("a"), F.explode("kept.first").alias("b")).distinct()
    root_of = components(links.filter("a <> b"))
    clustered = some.select("key").join(root_of.withColumnRenamed("node", "key"), "key").select("key", F.col("root").alias("cluster"))
    heads = root_of.select(F.col("root").alias("key"), F.col("root").alias("cluster")).distinct()
    return written(clustered.union(heads))


def arrays(docs: DataFrame, text_keys: DataFrame, text_col: str, size: int) -> DataFrame:
    """(key, hashes) of the sets of the named texts, once each."""
    source = docs.select(text_or_empty(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    # The list of texts grows with the corpus: a merge join at every size, which splits hot texts.
    named = source.join(text_keys.hint("merge"), "text_key", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _sets(size)(batches):
            rows = []
            for s in sets:
                key = _key(s)
                if key not in seen:
                    seen.add(key)
                    rows.append((key, s.tobytes()))
            if len(seen) > 1 << 18:
                seen.clear()
            if rows:
                keys, held = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(held, pa.binary())], names=["key", "hashes"]
                )

    return named.mapInArrow(run, "key long, hashes binary").dropDuplicates(["key"])


def banded(sets: DataFrame, per_cent: int, block: int) -> DataFrame:
    """Sets with `band`, `at` (block in the band) and the numbers of blocks of their band and its neighbours.

    Sizes of one band are within the factor of the similarity, so sets link within a band or
    with a neighbouring one. Blocks are counted from sums, and sets are dealt to them by hash.
    """
    # Sizes on the border of two bands may fall to either side; a link spans less than two bands.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / per_cent)) + 1e-9).cast("int")
    placed = sets.withColumn("band", band)
    sums = placed.groupBy("cluster", "band").agg(F.sum(F.greatest("n", F.lit(SMALLEST))).alias("mass"))
    blocks = sums.select("cluster", "band", F.ceil(F.col("mass") / block).cast("int").alias("blocks"))
    whole = sums.groupBy("cluster").agg((F.sum("mass") <= block).alias("small"))
    above = blocks.select("cluster", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("cluster", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    numbered = blocks.join(above, ["cluster", "band"], "left").join(below, ["cluster", "band"], "left").join(whole, "cluster")
    return placed.join(numbered.na.fill(0, ["above", "below"]), ["cluster", "band"]).withColumn(
        "at", F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("blocks")).cast("int")
    )


def _tile(band: Column, at: Column, other_band: Column, other: Column) -> Column:
    return F.struct(band.alias("band"), at.alias("at"), other_band.alias("other_band"), other.alias("other"))


def own_tiles(sets: DataFrame) -> DataFrame:
    """Each block with itself; a small cluster is one tile."""
    whole = F.when(F.col("small"), 0)
    band, at = F.coalesce(whole, "band"), F.coalesce(whole, "at")
    return sets.withColumn("tile", _tile(band, at, band, at))


def cross_tiles(sets: DataFrame) -> DataFrame:
    """Each block with every other one of its band and of the neighbouring bands, of large clusters.

    Tiles of one component only are left out.
    """
    large = sets.filter(~F.col("small"))
    band, at = F.col("band"), F.col("at")

    def up_to(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    met = F.concat(
        F.transform(
            F.filter(up_to("blocks"), lambda i: i != at),
            lambda i: _tile(band, F.least(at, i), band, F.greatest(at, i)),
        ),
        F.transform(up_to("above"), lambda i: _tile(band, at, band + 1, i)),
        F.transform(up_to("below"), lambda i: _tile(band - 1, i, band, at)),
    )
    # What the blocks hold, from sums: a tile of one component has nothing left to find.
    ranges = written(large.groupBy("cluster", "band", "at").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.first("blocks").alias("blocks"), F.first("above").alias("above"), F.first("below").alias("below"),
    ))
    tiles = ranges.select("cluster", "low", "high", F.explode(met).alias("tile")).groupBy("cluster", "tile").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("blocks")
    ).filter("low <> high and blocks = 2").select("cluster", "tile")
    members = tiles.select("cluster", "tile", F.explode(F.array(
        F.struct(F.col("tile.band").alias("band"), F.col("tile.at").alias("at")),
        F.struct(F.col("tile.other_band").alias("band"), F.col("tile.other").alias("at")),
    )).alias("m")).select("cluster", "tile", "m.band", "m.at")
    return large.join(members, ["cluster", "band", "at"])


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of a bitmap in which every shingle flips the bit that its highest hash bits name."""
    place = hashes >> np.uint64(64 - bits.bit_length() + 1)
    odd = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def tile_groups(sets: list[np.ndarray], label: np.ndarray, per_cent: int) -> np.ndarray:
    """Group of every set of a tile: `label` joined over all links. Sets are by ascending size.

    A set meets the smaller ones that its size allows; those of its own group are skipped.
    """
    n = np.array([len(s) for s in sets])
    groups = Groups(len(sets))
    order = np.argsort(label, kind="stable")
    known = order[:-1][label[order[1:]] == label[order[:-1]]], order[1:][label[order[1:]] == label[order[:-1]]]
    groups.unite(*known)
    begin = 0
    while begin < len(sets):
        # Sets of similar size share a bitmap width of about their size.
        end = int(np.searchsorted(n, max(64, 1 << int(n[begin]).bit_length()), "left"))
        end = max(end, begin + 1)
        first = int(np.searchsorted(n, least_common(int(n[begin]), per_cent), "left"))
        bits = max(64, 1 << int(n[end - 1] - 1).bit_length())
        maps = np.stack([bitmap(s, bits) for s in sets[first:end]])
        for i in range(max(begin, first + 1), end):
            smallest = max(first, int(np.searchsorted(n, least_common(int(n[i]), per_cent), "left")))
            others = np.arange(smallest, i)[::-1]
            others = others[groups.label[others] != groups.label[i]]
            if not len(others):
                continue
            differ = np.bitwise_count(maps[others - first] ^ maps[i - first]).sum(axis=1, dtype=np.int64)
            common = (n[others] + n[i] - differ) // 2
            others = others[common * 100 >= per_cent * (n[others] + n[i] - common)]
            for j in others.tolist():
                if groups.label[j] != groups.label[i]:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both * 100 >= per_cent * (int(n[i]) + int(n[j]) - both):
                        groups.unite(np.array([i]), np.array([j]))
        begin = end
    return groups.label


def _links(per_cent: int):
    """Rows (cluster, tile, key, label, hashes) sorted by tile to links (a, b) between labels and keys."""

    def links(keys: list[int], labels: list[int], held: list[bytes]) -> list[tuple[int, int]]:
        sets = [np.frombuffer(h, np.uint64) for h in held]
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), keys[i]))
        label = tile_groups([sets[i] for i in order], np.array([labels[i] for i in order]), per_cent)
        of = [labels[i] for i in order]
        return list({(of[i], of[r]) for i, r in enumerate(label.tolist()) if of[i] != of[r]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, keys, labels, held = None, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            found = links(keys, labels, held) if len(keys) > 1 else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            tiles, rest = batch.column("tile").to_pylist(), [batch.column(c) for c in ("key", "label", "hashes")]
            for i, (key, label, hashes) in enumerate(zip(*(c.to_pylist() for c in rest))):
                if tiles[i] != tile:
                    yield from close()
                    tile, keys, labels, held = tiles[i], [], [], []
                keys.append(key)
                labels.append(label)
                held.append(hashes)
        yield from close()

    return run


def links_in_tiles(tiles: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) between labels, found in tiles of bounded size."""
    keyed = tiles.select(F.xxhash64("cluster", "tile").alias("place"), F.concat_ws(":", "cluster", "tile.*").alias("tile"), "key", "label", "hashes")
    return keyed.repartition("place").sortWithinPartitions("place", "tile").select("tile", "key", "label", "hashes").mapInArrow(_links(per_cent), "a long, b long")


def _labelled(sets: DataFrame, root_of: DataFrame) -> DataFrame:
    """Sets whose label is its root."""
    root = root_of.select(F.col("node").alias("label"), "root")
    return sets.join(root, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root")


def set_labels(sets: DataFrame, per_cent: int, block: int) -> DataFrame:
    """(key, label): the component of each set over all links between sets of the same cluster.

    `sets` holds key, n, cluster, hashes and the columns of `banded`.
    """
    own = F.col("key").alias("label")
    root_of = components(written(links_in_tiles(own_tiles(sets.select("*", own)), per_cent)))
    labels = _labelled(sets.select("key", own), root_of)
    if not sets.filter("not small").limit(1).count():
        return labels
    large = written(_labelled(sets.filter("not small").select("*", own), root_of))
    # One set for each component: mostly enough to join the blocks of a large group.
    heads = large.groupBy("cluster", "label").agg(F.min(F.struct("n", "key")).alias("m")).select("m.key")
    few = large.join(heads, "key", "left_semi").select("cluster", "key", "n", "hashes", "label")
    root_of = components(written(links_in_tiles(own_tiles(banded(few, per_cent, block)), per_cent)))
    labels, large = _labelled(labels, root_of), _labelled(large, root_of)
    root_of = components(written(links_in_tiles(cross_tiles(large), per_cent)))
    return _labelled(labels, root_of)


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    per_cent: int = PER_CENT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    A document's set holds the hashes of its distinct word shingles (A-Z lower-cased, words
    between white space); fewer words are one shingle. component_id is the smallest id reachable
    over links, 100 * common >= per_cent * union; NULL ids are ignored in the minimum, and a
    component of NULL ids only has a NULL id. NULL texts and texts without words have no
    shingles and link with nothing. Repeated rows, and texts of equal sets, are one set; sets
    are told apart by a 64-bit digest and shingles by 64-bit hashes.
    """
    rows = written(sized(docs, id_col, text_col, shingle_words))
    sets = written(
        rows.filter("n > 0").groupBy("key").agg(
            F.first("n").alias("n"), F.min("id").alias("least_id"), F.count("*").alias("copies"), F.min("text_key").alias("text_key")
        )
    )
    clusters = candidate_clusters(docs, sets, text_col, shingle_words, per_cent)
    placed = written(banded(sets.select("key", "n", "text_key").join(clusters, "key"), per_cent, block))
    hashes = arrays(docs, placed.select("text_key"), text_col, shingle_words)
    labels = set_labels(written(hashes.join(placed.drop("text_key"), "key")), per_cent, block)
    rooted = sets.join(labels, "key", "left").withColumn("root", F.coalesce("label", "key")).drop("label")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.sum("copies").alias("members"))
    named = written(
        rooted.join(least.filter("members > 1"), "root").select("key", "component_id", F.lit(True).alias("joined"))
    )
    own = F.when(F.col("joined"), F.col("component_id")).otherwise(F.col("id"))
    return rows.join(named, "key", "left").select("id", F.col("n").alias("n_shingles"), own.alias("component_id"))
