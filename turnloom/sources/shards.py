"""Samples as shards of about equal numbers of tokens, with a manifest.

Rows fall into 2^16 buckets by the MD5 of their keys. The tokens of each bucket are summed, the
buckets are put in order with a running sum, and a shard is a range of the running sum, so
shards differ by about one bucket. A bucket that holds much of a shard, such as one key with
a large part of all rows, is split into slots first. Only sums of buckets and slots are ever
put in order in one place; their number has a fixed bound.

The manifest holds rows, tokens and a digest of each shard as read back from the files. It is
written last, and only if it adds up to the input, so a folder without one is unfinished and
is written anew by the next run; one with the manifest of the same rows is left as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

BUCKET_HEX = 4
# Slots of a bucket that holds more than one part in LARGE of a shard.
SLOTS = 64
LARGE = 20
SHARD = "shard"


def _bucket(keys: tuple[str, ...]) -> Column:
    text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, BUCKET_HEX), 16, 10).cast("int")


def token_count_of(samples: DataFrame) -> Column:
    """Tokens of a sample: the length of its ids."""
    return F.coalesce(F.size("input_ids"), F.lit(0)).cast("long")


def row_digest(columns: list[str]) -> Column:
    """A 64-bit hash of all columns, as a number that can be summed in any order."""
    given = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    # NULLs leave the hash as it is, so each value follows a mark that tells whether there is one.
    return F.xxhash64(*[part for c in given for part in (c.isNull(), c)]).cast("decimal(38,0)")


def plan_shards(samples: DataFrame, shards: int, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """``_bucket, _slots, _slot, shard, n_tokens``: which slot of which bucket goes to which shard."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    sized = samples.select(_bucket(keys).alias("_bucket"), token_count_of(samples).alias("n"))
    buckets = sized.groupBy("_bucket").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    total = buckets.agg(F.sum("tokens").alias("total"))
    large = (F.col("tokens") * shards * LARGE > F.col("total")) & (F.col("rows") > 1)
    slots = buckets.join(F.broadcast(total)).withColumn("_slots", F.when(large, SLOTS).otherwise(1))
    slots = slots.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    # Rows are dealt to slots in turn, so each holds about an equal part.
    share = slots.withColumn("n_tokens", F.col("tokens") / F.col("_slots"))
    before = Window.orderBy("_bucket", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("n_tokens").over(before), F.lit(0.0)) + F.col("n_tokens") / 2
    place = F.floor(middle * shards / F.greatest(F.col("total"), F.lit(1))).cast("int")
    return share.withColumn(SHARD, F.least(place, F.lit(shards - 1))).select("_bucket", "_slots", "_slot", SHARD, "n_tokens")


def with_shard(samples: DataFrame, shards: int, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """The samples with their ``shard``."""
    if SHARD in samples.columns:
        raise ValueError(f"the samples have a column {SHARD} already")
    plan = plan_shards(samples, shards, keys)
    buckets = plan.filter("_slot = 0").select("_bucket", "_slots")
    dealt = samples.withColumns({"_bucket": _bucket(keys), "_turn": F.monotonically_increasing_id()})
    # At most 2^16 rows, and 20 * 64 slots for each shard.
    placed = dealt.join(F.broadcast(buckets), "_bucket").withColumn("_slot", F.pmod("_turn", "_slots").cast("int"))
    ranges = plan.select("_bucket", "_slot", SHARD)
    return placed.join(F.broadcast(ranges), ["_bucket", "_slot"]).select(*samples.columns, SHARD)


def shard_totals(samples: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """Rows, tokens and digest by the given columns."""
    digest = F.coalesce(F.sum(row_digest(columns)), F.lit(0)).cast("string")
    tokens = F.coalesce(F.sum(token_count_of(samples)), F.lit(0))
    return samples.groupBy(*by).agg(F.count("*").alias("n_rows"), tokens.alias("n_tokens"), digest.alias("digest"))


def _sums(manifest: DataFrame) -> tuple:
    return tuple(
        manifest.agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)),
            F.coalesce(F.sum("n_tokens"), F.lit(0)),
            F.coalesce(F.sum(F.col("digest").cast("decimal(38,0)")), F.lit(0)).cast("string"),
        ).first()
    )


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def write_shards(samples: DataFrame, path: str, shards: int, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """Write ``path/data/shard=N`` files and ``path/manifest``; returns the manifest.

    The manifest has ``shard, shards, n_rows, n_tokens, digest`` for every shard that has rows.
    Running it again with the same rows and number of shards changes nothing; other rows, or
    a folder that an earlier run left without a manifest, are written anew.
    """
    spark = samples.sparkSession
    columns = samples.columns
    given = _sums(shard_totals(samples, columns))
    known = _stored(spark, path)
    if known is not None and _sums(known) == given and not known.filter(F.col("shards") != shards).limit(1).count():
        return known
    # What an earlier manifest describes is about to be replaced.
    empty = "shard int, shards int, n_rows long, n_tokens long, digest string"
    spark.createDataFrame([], empty).write.mode("overwrite").parquet(f"{path}/manifest")
    placed = with_shard(samples, shards, keys).repartition(shards, SHARD)
    placed.write.mode("overwrite").partitionBy(SHARD).parquet(f"{path}/data")
    back = shard_totals(_data(spark, path, samples.schema), columns, SHARD)
    found = back.select(SHARD, F.lit(shards).alias("shards"), "n_rows", "n_tokens", "digest")
    if _sums(found) != given:
        raise RuntimeError(f"{path}/data does not hold the samples that were given")
    found.repartition(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.schema(empty).parquet(f"{path}/manifest")


def _data(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(SHARD, T.IntegerType())])).parquet(f"{path}/data")


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Samples with their ``shard``, checked against the manifest."""
    manifest = _stored(spark, path)
    data = _data(spark, path, schema)
    if manifest is None or _sums(manifest) != _sums(shard_totals(data, schema.fieldNames())):
        raise ValueError(f"{path} has no manifest of its data")
    return data
