"""Benchmark decontamination with DataFrame operations only.

1. Screen: positions of documents whose shingle also occurs in a benchmark item. A
   window without such a shingle has similarity 0, so nothing is lost. A window is only
   compared with items of its own length, so positions are listed for each length.
2. Windows as long as an item, started at screened positions. A window that starts
   elsewhere can be moved to its next screened position without losing similarity.
   Windows with too few screened positions to reach the threshold are left out.
3. Each window and item gets a SimHash. Multi-index search: both are cut into
   blocks, items are listed under every value within radius // blocks bits of a block,
   so a window and an item within the radius agree in at least one entry. Candidates
   are checked for the radius.
4. Weighted Jaccard similarity of the shingle counts verifies each candidate.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, text_or_empty, written, without_ids
from .shingles import bit_counts, majority, with_shingles

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
# Distinct shingles of the benchmark up to which the screen is broadcast (16 bytes each).
BROADCAST_SHINGLES = 500_000


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))


def _entries(fp: Column, i: int, masks: list[int]) -> Column:
    """Keys of all values near block i of a fingerprint."""
    near = F.transform(F.lit(masks), lambda m: _block(fp, i).bitwiseXOR(m.cast("long")))
    return F.transform(near, lambda v: F.shiftleft(F.lit(i).cast("long"), BLOCK_BITS).bitwiseOR(v))


def _near_masks(bits: int) -> list[int]:
    return [sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(BLOCK_BITS), n)]


def _fingerprinted(rows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    exploded = rows.select(*keys, F.explode(hashes).alias("h"))
    counts = exploded.groupBy(*keys).agg(F.count("*").alias("n"), *bit_counts("h"))
    return counts.select(*keys, "n", majority("n").alias("fp"))


def item_shingles(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, item_key, size, hashes) of items with at least SHINGLE_WORDS words; item_key
    tells the texts of one item id apart."""
    texts = items.select(col(item_col).alias("item_id"), text_or_empty(text_col).alias("text"))
    return (
        with_shingles(texts, F.col("text"), SHINGLE_WORDS)
        .drop("text")
        .withColumn("size", F.size("hashes"))
        .withColumn("item_key", F.xxhash64("hashes"))
        .filter(F.col("item_id").isNotNull() & (F.col("size") > 0))
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, item_id, similarity, start_word, n_words): the best window of each document
    for each item it repeats.

    Texts are compared as lower-case words without punctuation; NULL counts as empty.
    Items of fewer than five words identify nothing and match nothing; so do NULL item
    ids. Of windows with equal similarity the first is given. Repeated rows of a
    document give one row; so do the texts of one item id, each searched on its own. NULL document ids are kept apart by text.
    """
    known = written(item_shingles(items, item_col, item_text_col).dropDuplicates(["item_id", "hashes"]))
    vocabulary = known.select(F.explode("hashes").alias("h"), "size").distinct()
    if known.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] <= BROADCAST_SHINGLES:
        vocabulary = F.broadcast(vocabulary)

    # Two hashes of the row name it, so that NULL ids and repeated ids need no special care.
    text = text_or_empty(text_col)
    named = docs.select(
        F.xxhash64(col(id_col).cast("string")).alias("k1"),
        F.xxhash64(text).alias("k2"),
        col(id_col).alias("id"),
        text.alias("text"),
    )
    hashed = with_shingles(named, F.col("text"), SHINGLE_WORDS)
    screened = hashed.select("k1", "k2", F.posexplode("hashes").alias("pos", "h")).join(vocabulary, "h")
    hits = screened.groupBy("k1", "k2", "size").agg(F.array_sort(F.collect_set("pos")).alias("hits"))
    suspects = named.join(hits, ["k1", "k2"]).dropDuplicates(["k1", "k2", "size"])
    suspects = with_shingles(suspects, F.col("text"), SHINGLE_WORDS).drop("text")

    size, start = F.col("size"), F.col("start")
    held = F.least(size, F.size("hashes") - start)
    # A window that reaches the threshold holds at least so many screened positions.
    need = F.ceil(F.lit(similarity) * (held + size) / (1 + similarity) - 1e-9).cast("int")
    starts = suspects.select("*", F.posexplode("hits").alias("i", "start"))
    reachable = F.get("hits", F.col("i") + need - 1) < start + size
    windows = starts.filter(reachable).select(
        "k1", "k2", "id", "start", "size", F.slice("hashes", start + 1, size).alias("hashes")
    )
    windows = written(windows)

    keys = ["k1", "k2", "start", "size"]
    near = _near_masks(radius // BLOCKS)
    fps = _fingerprinted(known, ["item_id", "item_key", "size"], "hashes").select("item_id", "item_key", "size", F.col("fp").alias("item_fp"))
    listed = fps.select(
        "*", F.explode(F.flatten(F.array(*[_entries(F.col("item_fp"), i, near) for i in range(BLOCKS)]))).alias("key")
    )
    probes = _fingerprinted(windows, keys, "hashes").select(
        *keys,
        "fp",
        F.explode(
            F.array(*[F.lit(i << BLOCK_BITS).cast("long").bitwiseOR(_block(F.col("fp"), i)) for i in range(BLOCKS)])
        ).alias("key"),
    )
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    # The entries are many times the size that Spark expects of them, so they are never broadcast.
    candidates = probes.join(listed.hint("merge"), ["size", "key"]).filter(close).select(*keys, "item_id", "item_key").distinct()

    window_counts = windows.select(*keys, F.explode("hashes").alias("h")).groupBy(*keys, "h").agg(F.count("*").alias("c"))
    item_counts = known.select("item_id", "item_key", "size", F.explode("hashes").alias("h")).groupBy("item_id", "item_key", "size", "h").agg(
        F.count("*").alias("ic")
    )
    shared = (
        candidates.join(window_counts, keys)
        .join(item_counts, ["item_id", "item_key", "size", "h"])
        .groupBy(*keys, "item_id", "item_key")
        .agg(F.sum(F.least("c", "ic")).alias("shared"))
    )
    held = windows.select(*keys, "id", F.size("hashes").alias("held"))
    scored = shared.join(held, keys).withColumn(
        "similarity", F.col("shared") / (F.col("held") + F.col("size") - F.col("shared"))
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "held")).alias("best")
    return (
        scored.filter(F.col("similarity") >= similarity - 1e-9)
        .groupBy("k1", "k2", "item_id")
        .agg(F.first("id").alias("id"), best)
        .select(
            "id",
            "item_id",
            "best.similarity",
            (-F.col("best.s")).cast("long").alias("start_word"),
            (F.col("best.held") + SHINGLE_WORDS - 1).cast("long").alias("n_words"),
        )
    )


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose id repeats no benchmark item. Rows without an id stay."""
    return without_ids(docs, id_col, leaks(docs, items, id_col, text_col).select("id").distinct())
