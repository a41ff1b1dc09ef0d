"""Shards of equal token numbers and their manifest."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from turnloom.sources import shards

SCHEMA = "conv_id long, input_ids array<int>, labels array<int>, note string"


def samples(spark, n=3000, hot=0):
    """Samples of very different lengths, `hot` of them of one key."""
    rnd = random.Random(n + hot)
    rows = [(i, [rnd.randrange(9)] * int(rnd.paretovariate(1.2) * 10 % 3000), None, None) for i in range(n)]
    rows += [(-1, [1, 2, 3] * 20, [0], "same")] * hot
    rows += [(None, None, None, None), (None, [], [], "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def contents(df):
    return sorted(df.select("conv_id", "input_ids", "labels", "note").collect(), key=repr)


@pytest.mark.parametrize("hot", [0, 2500])
def test_shards_are_balanced_and_complete(spark, tmp_path, hot):
    given = samples(spark, hot=hot)
    path = str(tmp_path / "out")
    manifest = shards.write_shards(given, path, 8).collect()
    tokens = [m.n_tokens for m in manifest]
    assert sorted(m.shard for m in manifest) == list(range(8))
    assert max(tokens) < 1.1 * sum(tokens) / 8 and min(tokens) > 0.9 * sum(tokens) / 8
    back = shards.read_shards(spark, path, given.schema)
    assert contents(back) == contents(given)
    found = {r["shard"]: (r["n_rows"], r["n_tokens"], r["digest"]) for r in shards.shard_totals(back, given.columns, "shard").collect()}
    assert found == {m.shard: (m.n_rows, m.n_tokens, m.digest) for m in manifest}


def test_running_again(spark, tmp_path):
    path = str(tmp_path / "out")
    given = samples(spark, 300)
    shards.write_shards(given, path, 4)

    def files():
        return sorted(p.name for p in (tmp_path / "out").rglob("part-*.parquet"))

    first = files()
    shards.write_shards(given.repartition(3), path, 4)
    assert files() == first  # the same rows in any order: nothing is written
    shards.write_shards(given, path, 2)
    assert files() != first and shards.read_shards(spark, path, given.schema).count() == given.count()
    more = given.union(given.limit(1))
    shards.write_shards(more, path, 2)
    assert contents(shards.read_shards(spark, path, given.schema)) == contents(more)


def test_unfinished_or_changed_data_is_refused_and_written_anew(spark, tmp_path):
    path = str(tmp_path / "out")
    given = samples(spark, 100)
    given.withColumn("shard", F.lit(0)).limit(50).write.partitionBy("shard").parquet(f"{path}/data")
    with pytest.raises(ValueError):
        shards.read_shards(spark, path, given.schema)
    shards.write_shards(given, path, 3)
    given.limit(1).write.mode("append").parquet(f"{path}/data/shard=0")
    with pytest.raises(ValueError):
        shards.read_shards(spark, path, given.schema)


def test_edge_tables(spark, tmp_path):
    empty = samples(spark, 0).limit(0)
    assert shards.write_shards(empty, str(tmp_path / "empty"), 3).collect() == []
    assert shards.read_shards(spark, str(tmp_path / "empty"), empty.schema).count() == 0
    with pytest.raises(ValueError):
        shards.with_shard(empty.withColumn("shard", F.lit(1)), 2)
    with pytest.raises(ValueError):
        shards.plan_shards(empty, 0)


def test_digest_tells_columns_apart(spark):
    rows = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert rows.select(shards.row_digest(["a", "b"])).distinct().count() == 2
