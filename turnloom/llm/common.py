"""Shared pieces of the corpus operators: columns, tables, and written intermediate results."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, str] = {}


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir`.

    Where that is unset, a local session gets a temporary folder; a cluster
    must set it, since executors do not share local folders.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="turnloom-")
    return _local_folders[app]


def written(df: DataFrame) -> DataFrame:
    """The rows of `df`, stored once in the shared folder and read back.

    Cuts the lineage like a checkpoint, but computes `df` only once, keeps it
    columnar, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/turnloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with columns that are computed once, however often they are used.

    Spark may copy an expression into its users, lambda bodies and inferred filters
    included; it does not copy the output of a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def without_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is not in the column `id` of `ids`; rows with a NULL id stay.

    Any columns of `docs` may have any name.
    """
    taken = {name.lower() for name in docs.columns}
    name = next(n for n in (f"_id{i}" for i in range(len(taken) + 1)) if n not in taken)
    return docs.join(ids.select(F.col("id").alias(name)), col(id_col) == F.col(name), "left_anti")


def nullable(schema: T.StructType) -> T.StructType:
    """The schema with every column allowed to be NULL, for rows made in Python."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each, so that one batch of
    very long texts is not expanded into Python objects at once."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size or 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def crc32_text(value: Column) -> Column:
    """crc32 of an id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def crc32_of(value: object) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())
