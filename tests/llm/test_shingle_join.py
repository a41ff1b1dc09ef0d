"""The shingle join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnloom.llm import queries, shingle_join


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(rows, per_cent=80):
    """[(id, n, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= per_cent * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(doc_id, len(s), least.get(g)) for (doc_id, _), s, g in zip(rows, sets, group)]


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(40):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 5, 30, 80, 200, 700]))]
        if g % 3 == 0:
            base += passage  # a passage that many documents share
        for _ in range(rnd.choice([1, 1, 2, 4])):
            rows.append((len(rows) * 7 % 1009, " ".join(edited(rnd, base, rnd.choice([0, 0, 1, 2, len(base) // 40, len(base) // 25])))))
    base = [f"b{i}" for i in range(150)]
    chain = list(base)
    for i in range(60):  # neighbours link, the ends do not
        chain = chain[2:] + [f"c{i}", f"d{i}"]
        rows.append((2000 + i, " ".join(chain)))
    for i in range(90):  # a large group of near copies
        rows.append((3000 + i, " \n ".join(edited(rnd, base, 1)).upper()))
    rows += [(1500, None), (1501, ""), (1502, " \t"), (1503, "one two"), (1504, "One  TWO"), (1505, "one"), (None, rows[0][1]), (1506, "é É"), (1507, "É é")]
    rows += [(1508, rows[5][1]), (1508, rows[5][1]), (None, "only without id here now"), (None, "only without id here now")]
    return rows


@pytest.mark.parametrize("block", [shingle_join.BLOCK, 4000, 600])
def test_components_equal_all_pairs(spark, rows, block):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"key": F.lit(1), "n": F.lit("x"), "id": F.lit(2)})
    got = [tuple(r) for r in shingle_join.similar_components(frame, block=block).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op13_shingle_join(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_border_of_the_similarity(spark):
    """100 * common == 80 * union links, one shingle less does not."""
    a = [f"w{i}" for i in range(94)]  # 90 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:76])), (3, " ".join(a[:75]))]  # 72 of 90 and 71 of 90
    assert plain(rows[:2])[1][2] == 1 and plain([rows[0], rows[2]])[1][2] == 3
    for some in (rows[:2], [rows[0], rows[2]]):
        got = [tuple(r) for r in shingle_join.similar_components(spark.createDataFrame(some, "doc_id long, text string")).collect()]
        assert sorted(got) == sorted(plain(some))


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, "a b c d e f g")]):
        got = [tuple(r) for r in shingle_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert got == plain(rows)


def test_shared_rows_over_any_batches():
    rnd = random.Random(1)
    rows = sorted((rnd.randrange(30), rnd.randrange(12)) for _ in range(150)) + [(40, 1), (41, 1), (41, 1), (42, 1), (42, 2)]
    keys = {}
    for h, k in rows:
        keys.setdefault(h, set()).add(k)
    expected = sorted((h, k) for h, ks in keys.items() if len(ks) > 1 for k in ks)
    for size in (1, 2, 3, 50, 1000):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[b : b + size]], pa.int64()) for i in (0, 1)], names=["h", "key"])
            for b in range(0, len(rows), size)
        ]
        got = [tuple(x.values()) for out in shingle_join._shared(iter(batches)) for x in out.to_pylist()]
        assert got == expected


def test_bitmaps_never_underestimate_the_overlap():
    rng = np.random.default_rng(5)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 600).astype(np.uint64) * np.uint64(2)
        a, b = (np.unique(rng.choice(pool, 300)) for _ in range(2))
        differ = int(np.bitwise_count(shingle_join.bitmap(a, 256) ^ shingle_join.bitmap(b, 256)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2
