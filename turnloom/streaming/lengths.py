"""Length reports of a growing corpus, from a stored histogram that merges.

Each batch of a stream adds one small table: samples per length, after and before the token
cut. It is stored under the stream's name and the batch's id and replaces what an earlier
attempt of that batch left, so a repeated batch counts once. Reports read the sums over all
batches, never the samples again. `compact` adds the batches so far into one table; batches
that it holds are ignored from then on, whether their files remain or are written once more.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import stats
from ..options import PrepOptions
from ..plans.prepare import prepare_lengths
from .samples import checkpoint_location

# After and before the token cut.
KINDS = {"final": "final_length", "structured": "structured_length"}
STORED = "kind string, length long, n_samples long"
BATCHES = f"{STORED}, stream string, batch long"
BASES = f"{STORED}, stream string, upto long"


def _histograms(lengths: DataFrame) -> DataFrame:
    """``kind, length, n_samples`` of a table of lengths, read once."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("length")) for k, c in KINDS.items()])
    return lengths.select(F.explode(pairs).alias("p")).groupBy("p.kind", "p.length").agg(F.count("*").alias("n_samples"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; empty where nothing has been stored yet."""
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def add_batch(lengths: DataFrame, path: str, stream: str, batch: int) -> None:
    """Store the histograms of one batch; storing the same batch again replaces it."""
    if not stream or "/" in stream or "=" in stream:
        raise ValueError("a stream needs a plain name")
    folder = f"{path}/batches/stream={stream}/batch={batch}"
    _histograms(lengths).coalesce(1).write.mode("overwrite").parquet(folder)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """``stream, kind, length, n_samples`` over all batches, each counted once."""
    bases, batches = _read(spark, f"{path}/bases", BASES), _read(spark, f"{path}/batches", BATCHES)
    last = bases.groupBy("stream").agg(F.max("upto").alias("last"))
    held = bases.join(last, "stream").filter("upto = last")
    newer = batches.join(last, "stream", "left").filter("batch > coalesce(last, -1)")
    columns = ("stream", "kind", "length", "n_samples")
    rows = held.select(*columns).unionByName(newer.select(*columns))
    return rows.groupBy("stream", "kind", "length").agg(F.sum("n_samples").alias("n_samples"))


def compact(spark: SparkSession, path: str) -> None:
    """Add the batches of every stream that are stored now into one table for each stream.

    Written under the id of its last batch; until it is complete, reports use the older tables.
    """
    ends = _read(spark, f"{path}/batches", BATCHES).groupBy("stream").agg(F.max("batch").alias("upto")).collect()
    known = {r["stream"]: r["last"] for r in _read(spark, f"{path}/bases", BASES).groupBy("stream").agg(F.max("upto").alias("last")).collect()}
    for stream, upto in ends:  # one row for each stream
        if upto > known.get(stream, -1):
            rows = merged(spark, path).filter(F.col("stream") == stream).drop("stream")
            rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/bases/stream={stream}/upto={upto}")


def length_report(spark: SparkSession, path: str, max_length: int | None = 0) -> dict[str, DataFrame]:
    """The tables of :func:`turnloom.operators.stats.length_report` over everything stored."""
    rows = merged(spark, path).groupBy("kind", "length").agg(F.sum("n_samples").alias("n_samples"))
    histogram = rows.filter("kind = 'final'").select("length", "n_samples")

    def largest(kind: str):
        return F.max(F.when(F.col("kind") == kind, F.col("length")))

    raw = rows.agg(
        largest("structured").alias("dataset_max"),
        largest("final").alias("final_max"),
        F.sum(F.when(F.col("kind") == "final", F.col("n_samples"))).alias("n_samples"),
    ).filter(F.col("n_samples") > 0)
    return {**stats.histogram_report(histogram, max_length), "raw_lengths": raw}


def length_stream(
    stream: DataFrame,
    path: str,
    name: str,
    opts: PrepOptions = PrepOptions(),
    keep: tuple[str, ...] = ("conv_id",),
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Add the lengths of all conversations available now to the stored histogram and stop."""
    location = checkpoint or checkpoint_location(stream.sparkSession, name)

    def store(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, path, name, batch_id)

    return (
        prepare_lengths(stream, opts, keep)
        .writeStream.queryName(name)
        .foreachBatch(store)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
