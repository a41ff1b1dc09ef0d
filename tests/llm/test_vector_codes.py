"""Vector codes against trying all entries in plain Python."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm import queries, vector_codes


def floored(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(1024 * x) for x in vector]


def plain(rows, entries=256, rounds=4, parts=4):
    """{id: (code, error, label_error)} and the digest; ids are unique."""
    kept = sorted((i, v, label) for i, vector, label in rows if (v := floored(vector)) is not None)
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for i, found in members.items():
                books[p][i] = [sum(x) // len(found) for x in zip(*found)]
    out, by_label = {}, {}
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label)
        by_label[label] = by_label.get(label, 0) + out[i][1]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: (code, error, by_label[label]) for i, (code, error, label) in out.items()}, digest


def given(n=420, width=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i * 3, [float(np.float32(x)) for x in rng.normal(0, 0.3, width)], int(rng.integers(4))) for i in range(n)]
    rows += [(i * 3 + 1, rows[i][1], None) for i in range(40)]  # repeated vectors, no label
    rows += [(2, None, 1), (5, [None] + [0.5] * 7, 1), (8, [float("nan")] * 8, 2), (11, [float("inf")] + [0.1] * 7, None)]
    rng.shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_query_equals_trying_all_entries(spark, tmp_path):
    rows = given()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"near": F.lit(1), "error": F.lit("x")})
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    expected, digest = plain(rows)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in got} == expected
    assert len(got) == len(expected)


def test_pivots_save_evaluations_and_keep_ties(spark):
    rng = np.random.default_rng(0)
    parts = rng.integers(-300, 300, (500, 3))
    entries = np.concatenate([rng.integers(-300, 300, (60, 3)), parts[:4], parts[:4]])
    pivots = vector_codes.far_apart(entries, 6)
    near = vector_codes.to_pivots(parts, pivots)
    entry, distance, evaluated = vector_codes.nearest(parts, near, vector_codes.Codebook(entries, pivots))
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert (entry[:4] == [60, 61, 62, 63]).all()  # of equal entries the first
    assert evaluated < every.size / 4


@pytest.mark.parametrize("scale", [1.0, 3e9])
def test_large_components_stay_exact(spark, scale):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) * scale for x in rng.normal(0, 1, 4)], 0) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    codes, books = vector_codes.vector_codes(frame, entries=8)
    expected, digest = plain(rows, entries=8)
    assert vector_codes.codebooks_digest(books) == digest
    fits = 2**63
    got = {r["id"]: ("".join(f"{e:02x}" for e in r["entries"]), r["error"]) for r in codes.collect()}
    assert got == {i: (c, e if e < fits else None) for i, (c, e, _) in expected.items()}


def test_edge_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)], [(1, [1.0, 2.0, 3.0], 1)]):
        codes, books = vector_codes.vector_codes(spark.createDataFrame(rows, SCHEMA))
        assert vector_codes.with_label_errors(codes).collect() == [] and books == []
    rows = [(None, [0.0] * 4, None), (7, [1.0] * 4, None), (7, [1.0] * 4, None), (9, [1.0] * 8, None)]
    codes, books = vector_codes.vector_codes(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r["id"] or 0, r["error"], r["label_error"]) for r in vector_codes.with_label_errors(codes).collect())
    assert got == [(0, 0, 0), (7, 0, 0), (7, 0, 0)] and len(books[0]) == 3  # the longer vector is left out
