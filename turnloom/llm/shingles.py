"""Word shingles and their SimHash as column expressions; no Python code runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import computed

# One long holds two counters of 31 bits, more than an array can have entries.
LANES = 2
LANE_BITS = 31
MAX_SHINGLES = (1 << LANE_BITS) - 1


def words(text: Column) -> Column:
    """Lower-case runs of letters and numbers."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """A 64-bit hash of every run of `size` words; an empty array for fewer words."""

    def hashed(i: Column) -> Column:
        return F.xxhash64(*[F.get(tokens, i + k) for k in range(size)])

    last = F.size(tokens) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), hashed)).otherwise(
        F.array().cast("array<bigint>")
    )


def with_shingles(df: DataFrame, text: Column, size: int) -> DataFrame:
    """`df` with the column `hashes`: the shingles of a text."""
    tokens = computed(df, _words=words(text))
    return computed(tokens, hashes=shingle_hashes(F.col("_words"), size)).drop("_words")


def bit_counts(hashed: str) -> list[Column]:
    """Aggregates of how often each bit of a column is set, packed; for groups of at most
    MAX_SHINGLES rows."""
    def packed(group: int) -> str:
        bits = (
            f"shiftleft(shiftrightunsigned(`{hashed}`, {LANES * group + lane}) & 1L, {LANE_BITS * lane})"
            for lane in range(LANES)
        )
        return " | ".join(bits)

    return [F.expr(f"sum({packed(group)})").alias(f"bits_{group}") for group in range(64 // LANES)]


def majority(n: str) -> Column:
    """The fingerprint from columns bits_0.. of `bit_counts`: bits set in over half of column n."""

    def bit(i: int) -> str:
        count = f"shiftrightunsigned(bits_{i // LANES}, {LANE_BITS * (i % LANES)}) & {MAX_SHINGLES}L"
        return f"shiftleft(cast(({count}) * 2 > `{n}` AS bigint), {i})"

    return F.expr(" | ".join(map(bit, range(64))))
