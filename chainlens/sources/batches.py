"""Batch catalogue: which batches a dataset holds, from file listings alone.

A listing row is a file (``files.list_files``: path, size, modification time); its batch
comes from a ``block_batch=N`` folder or from the ``..._to_N`` in its name. Nothing here
opens a data file, so discovery costs the same whether a batch holds a megabyte or a
terabyte. A job that writes batches adds one record per batch and commit beside its
table: the batch, and for each input the number of files, their bytes and the newest
modification time. Batches whose inputs still look like that are done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlens.sources.files import BATCH, _exists, batch_of_filename, list_files

#: what tells one state of a batch's files from another
STATE = ("files", "bytes", "newest")


def batch_of_path(path: Column) -> Column:
    """The batch of a file: its ``block_batch=N`` folder, else the ``to_N`` of its name; null if it has neither."""
    folder = F.nullif(F.regexp_extract(path, rf"/{BATCH}=(\d+)/", 1), F.lit("")).cast("bigint")
    return F.coalesce(folder, batch_of_filename(F.element_at(F.split(path, "/"), -1)))


def batch_files(spark: SparkSession, path: str) -> DataFrame:
    """(block_batch, path, length, modificationTime) of every file that belongs to a batch."""
    return (list_files(spark, path).select(batch_of_path(F.col("path")).alias(BATCH), "path", "length", "modificationTime")
            .filter(F.col(BATCH).isNotNull()))


def batch_states(files: DataFrame, side: str = "") -> DataFrame:
    """(block_batch, files, bytes, newest) of a listing; column names start with ``side``."""
    return files.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias(f"{side}files"), F.sum("length").alias(f"{side}bytes"),
        F.max("modificationTime").alias(f"{side}newest"))


def common_batches(spark: SparkSession, txs_path: str, blocks_path: str) -> DataFrame:
    """Batches that both datasets hold (S11), with the state of their files on either side."""
    return batch_states(batch_files(spark, txs_path), "txs_").join(
        batch_states(batch_files(spark, blocks_path), "blocks_"), BATCH)


def catalog_path(out_path: str) -> str:
    """Where the records of a batched table are kept."""
    return f"{out_path.rstrip('/')}__catalog"


def recorded(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The records of a table, or None before the first commit."""
    path = catalog_path(out_path)
    return spark.read.parquet(path) if _exists(spark, path) else None


def record(states: DataFrame, out_path: str) -> None:
    """Add the records of a commit; call it after the data is committed. A job that is lost
    in between does the same batches again, and overwrites them with the same rows."""
    states.coalesce(1).write.mode("append").parquet(catalog_path(out_path))


def pending_states(spark: SparkSession, states: DataFrame, out_path: str, refresh: bool = False) -> DataFrame:
    """The rows of ``states`` that the table at ``out_path`` lacks.

    With ``refresh`` a batch whose files changed since its record is pending again. A
    table without records (written by other means) is taken to hold its folders."""
    seen = recorded(spark, out_path)
    if seen is None:
        return states.join(batch_files(spark, out_path).select(BATCH).distinct(), BATCH, "left_anti")
    return states.join(seen, states.columns if refresh else [BATCH], "left_anti")


def read_batches(spark: SparkSession, path: str, ids: Sequence[int], schema: T.StructType | None = None) -> DataFrame:
    """The rows of the batches ``ids``: only their folders are listed and read, or only
    their files where batches are files. ``ids`` is a bounded list (one commit's)."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    ids = sorted(set(ids))
    folders = [f"{path.rstrip('/')}/{BATCH}={i}" for i in ids]
    if ids and _exists(spark, folders[0]):
        df = reader.parquet(*folders)
    else:
        found = batch_files(spark, path).filter(F.col(BATCH).isin(ids)).select("path").collect()
        if not found:
            raise FileNotFoundError(f"no file of the batches {ids[:5]} in {path}")
        df = reader.parquet(*sorted(r.path for r in found))
        df = df.withColumn(BATCH, batch_of_filename(F.col("_metadata.file_name")))
    return df.withColumn(BATCH, F.col(BATCH).cast("bigint"))
