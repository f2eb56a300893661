"""Range index of a batched dataset (S12): the least and the greatest block of each batch.

The index lies beside the dataset, one row per batch and state of its files (see
``sources/batches.py``). A block range or "latest" becomes a list of batches before any
data file is opened, so that only their folders are listed and read. A batch that the
index does not know, or whose files changed since, is always read: a stale index costs
time, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.plans.jobs import commits, scratch_path
from chainlens.sources.batches import batch_files, batch_states, read_batches
from chainlens.sources.files import BATCH, _exists, read_dataset, select_blocks

#: so many batches are read by their folders; more of them by a range of batch ids
MOST_FOLDERS = 1000


def ranges_path(path: str) -> str:
    """Where the index of a dataset is kept."""
    return f"{path.rstrip('/')}__ranges"


def block_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(block_batch, files, bytes, newest, first_block, last_block) of every batch in the listing;
    the blocks are null where the index does not know the batch as it is."""
    states = batch_states(batch_files(spark, path))
    if not _exists(spark, ranges_path(path)):
        return states.withColumns({"first_block": F.lit(None).cast("bigint"), "last_block": F.lit(None).cast("bigint")})
    seen = spark.read.parquet(ranges_path(path)).dropDuplicates(states.columns)
    return states.join(seen, states.columns, "left")


def index_ranges(spark: SparkSession, path: str, per_commit: int = MOST_FOLDERS) -> None:
    """Add what the index lacks: one narrow scan of new and changed batches, at most ``per_commit``
    of them at a time. A batch without any row, or with null blocks only, gets the empty range 0 to -1."""
    todo_path = scratch_path(spark, "ranges")
    block_ranges(spark, path).filter("first_block is null").drop("first_block", "last_block").write.parquet(todo_path)
    todo = spark.read.parquet(todo_path)
    for rows in commits(todo, per_commit):
        df = read_batches(spark, path, [r[BATCH] for r in rows])
        found = df.groupBy(BATCH).agg(F.min("block_number").cast("bigint").alias("first_block"),
                                      F.max("block_number").cast("bigint").alias("last_block"))
        out = spark.createDataFrame(rows, todo.schema).join(found, BATCH, "left").fillna({"first_block": 0, "last_block": -1})
        out.coalesce(1).write.mode("append").parquet(ranges_path(path))


def batches_of_blocks(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None,
                      latest: bool = False) -> DataFrame:
    """(block_batch) of the batches that may hold blocks ``lo`` to ``hi`` (inclusive, open ends), or the latest block."""
    ranges = block_ranges(spark, path)
    first, last = F.col("first_block"), F.col("last_block")
    fits = last >= first
    if latest:
        fits = fits & (last == ranges.filter(fits).select(F.max("last_block")).scalar())
    else:
        if lo is not None:
            fits = fits & (last >= lo)
        if hi is not None:
            fits = fits & (first <= hi)
    return ranges.filter(first.isNull() | fits).select(BATCH)


def select_block_range(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None,
                       latest: bool = False) -> DataFrame:
    """S12 over a batched folder: rows of blocks ``lo`` to ``hi`` (inclusive, open ends), or of the latest block.

    Only the batches concerned are listed and read; if they are very many, the range of
    their ids prunes folders instead. No batch concerned: no rows."""
    ids = batches_of_blocks(spark, path, lo, hi, latest)
    few = sorted(r[0] for r in ids.limit(MOST_FOLDERS + 1).collect())
    if not few:
        return read_dataset(spark, path).filter(F.lit(False))
    if len(few) <= MOST_FOLDERS:
        df = read_batches(spark, path, few)
    else:
        low, high = ids.agg(F.min(BATCH), F.max(BATCH)).first()
        columns = read_batches(spark, path, few[:1]).drop(BATCH).schema
        df = read_dataset(spark, path, columns).filter(F.col(BATCH).between(low, high))
    return select_blocks(df, lo, hi, latest)
