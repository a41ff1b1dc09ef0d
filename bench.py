"""Time the headline queries; prints one JSON line.

Results go to a sink that discards rows, so every row and column is computed
and nothing is collected. BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from turnloom.plans import inputs
from turnloom.plans.queries import QUERIES

HEADLINES = (
    "rendered_lengths",
    "token_counts",
    "assemble",
    "think_extract",
    "role_spans",
    "loss_answer_only",
    "trace",
    "len_pct",
    "samples",
    "truncate_right",
    "exchange_samples",
    "external_samples",
    "sample_stats",
    "parse_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("turnloom-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Token work costs far more per byte than a scan, so small inputs are
        # worth splitting further than the 1 MB default.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    run("token_counts")
    seconds = {name: run(name) for name in HEADLINES}
    conversations = inputs.conversations(spark, sf_dir).select("conv_id").distinct().count()
    tokens = QUERIES["token_counts"](spark, sf_dir).groupBy().sum("total_tokens").first()[0]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "conversations": conversations,
                "conversations_per_second": round(conversations / seconds["samples"], 1),
                "tokens_per_second": round(tokens / seconds["token_counts"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
