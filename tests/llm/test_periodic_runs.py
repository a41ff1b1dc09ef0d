"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from turnloom.llm import periodic_runs, queries


def plain_runs(words):
    """(start, length, period) of all runs: for each period the maximal stretches of equal words."""
    found = set()
    for q in range(1, len(words) // 3 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + q
                inside = any(s <= start and s + n >= start + length and q % p == 0 for s, n, p in found)
                if length >= max(24, 3 * q) and not inside:
                    found.add((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rnd):
    n, letters, words = rnd.choice([24, 60, 150, 400]), rnd.choice([1, 2, 3, 10]), []
    while len(words) < n:
        unit = [rnd.randrange(letters) for _ in range(rnd.choice([1, 2, 3, 7, 8, 9, 16, 17, 40]))]
        if words and rnd.random() < 0.4:
            at = rnd.randrange(len(words))
            unit = words[at : at + rnd.randint(1, 50)]
        words += (unit * rnd.randint(1, 7))[: rnd.randint(1, 200)]
    return words[:n]


def test_runs_equal_a_search_over_all_periods_however_words_are_appended():
    rnd = random.Random(11)
    for _ in range(120):
        words = random_words(rnd)
        expected = plain_runs(words)
        for append in (1 << 14, 1, 7, 50):
            assert periodic_runs.runs_of(np.array(words), append) == expected


def test_long_regular_texts_take_little_time():
    a, b = "a", "ab"
    while len(b) < 120_000:
        a, b = b, b + a
    began = time.time()
    assert periodic_runs.runs_of(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    assert len(periodic_runs.runs_of(np.tile(np.append(np.zeros(50, np.int64), 1), 2000))) == 2001
    assert periodic_runs.runs_of(np.array([ord(c) for c in b]))
    assert time.time() - began < 30


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_query_equals_plain_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " \t".join(f"w{x}é" for x in random_words(rnd))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \n"), (None, "a b " * 20), (None, None), (903, "a b c " * 30), (903, "a b c " * 30)]
    rows += [(904, "x y z " * 12), (905, "word " * 23), (906, "word " * 24), (907, "nul \x00 \u0085 " * 9)]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    frame.withColumns({"runs": F.lit(1), "id": F.lit("x")}).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((plain_row(*r) for r in rows), key=repr)


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
