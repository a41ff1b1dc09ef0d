"""Report tables against sorted lists."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from turnloom.operators import stats


def lengths(spark, values):
    return spark.createDataFrame([(v, v) for v in values], "structured_length int, final_length int")


def percentiles(spark, values, limit=0):
    table = stats.length_percentiles(stats.length_histogram(lengths(spark, values)), limit)
    return {r.label: (r.length, r.at_max) for r in table.collect()}


def test_percentiles_follow_the_index_rule(spark):
    rng = random.Random(1)
    for n in (1, 2, 7, 100, 101):
        values = [rng.randint(1, 60) for _ in range(n)]
        ordered = sorted(values)
        found = percentiles(spark, values)
        for p in stats.PERCENTILES:
            assert found[f"p{p}"][0] == ordered[int((p / 100.0) * (n - 1))]
        assert found["max"][0] == ordered[-1]


def test_borders_count_twice_and_full_windows_count_as_truncated(spark):
    hist = stats.length_histogram(lengths(spark, [25, 50, 99, 100, 100]))
    shares = {r.bucket: r for r in stats.window_utilisation(hist, 100).collect()}
    assert [shares[b].n_samples for b in ("< 25%", "25-50%", "50-75%", "75-99%", "at max")] == [1, 2, 1, 1, 2]
    assert shares["at max"].bar == "█" * 8 + "░" * 12
    summary = stats.truncation_summary(hist, 100).first()
    assert (summary.truncated, summary.not_truncated, summary.truncated_share) == (2, 3, 0.4)
    assert percentiles(spark, [25, 50, 99, 100, 100], 100)["p99"] == (100, True)


def test_documented_shares(spark):
    values = [5120] * 6 + [100] * 241
    summary = stats.truncation_summary(stats.length_histogram(lengths(spark, values)), 5120).first()
    assert (summary.truncated, summary.not_truncated) == (6, 241)
    assert round(summary.truncated_share * 100, 1) == 2.4


def test_empty_input_gives_empty_reports(spark):
    for table in stats.length_report(lengths(spark, []), 100).values():
        assert table.count() == 0


def test_raw_lengths_fall_back_to_final(spark):
    df = lengths(spark, [3, 9]).withColumn("structured_length", F.col("structured_length") + 5)
    assert stats.raw_lengths(df).first().dataset_max == 14
    assert stats.raw_lengths(df.drop("structured_length")).first().dataset_max == 9
