"""Batch jobs over block-batched datasets (Q29 batch form, Q30, S5-S7, S16, S17).

All writes are partitioned by ``block_batch`` with *dynamic* partition
overwrite: a re-run (after executor loss, a killed job, or on purpose)
replaces exactly the batches it computes, and Spark's commit protocol only
publishes a batch's files when the job commits. Batches already in the output
are skipped with a ``left_anti`` join, so a second run writes nothing.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.operators.extend import rollup_transactions
from chainlens.session import checkpoint_dir
from chainlens.sources.batches import (batch_files, batch_states, common_batches, pending_states, read_batches,
                                       record)
from chainlens.sources.files import BATCH, _exists, list_files

DEFAULT_FILE_BYTES = 512 * 1024 * 1024


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/chainlens-{name}-{uuid.uuid4().hex[:12]}"


def write_batches(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Write by batch, replacing only the batches present in ``df``."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(BATCH)
       .parquet(path))


def finished_path(path: str) -> str:
    """The record of finished batch ids, beside the table."""
    return f"{path.rstrip('/')}__finished"


def mark_finished(todo: DataFrame, path: str) -> None:
    """Record batches after their data is committed; a batch without any output row is finished too."""
    todo.select(BATCH).coalesce(1).write.mode("append").parquet(finished_path(path))


def done_batches(spark: SparkSession, path: str) -> DataFrame:
    """Finished batch ids: the record; for a table written without one, the batches in its listing."""
    if _exists(spark, finished_path(path)):
        return spark.read.parquet(finished_path(path)).select(BATCH).distinct()
    return batch_files(spark, path).select(BATCH).distinct()


def pending_batches(txs: DataFrame, blocks: DataFrame, done: DataFrame) -> DataFrame:
    """Batches present in both inputs (S11) and not yet written."""
    both = (txs.select(BATCH).distinct()
               .join(blocks.select(BATCH).distinct(), BATCH, "inner"))
    return both.join(done, BATCH, "left_anti")


def id_range(ids: DataFrame) -> tuple[int | None, int | None]:
    """(smallest, largest) batch id, two numbers on the driver; (None, None) without ids."""
    return tuple(ids.agg(F.min(BATCH), F.max(BATCH)).first())


def only_batches(df: DataFrame, ids: DataFrame, lo: int, hi: int) -> DataFrame:
    """Rows of the batches ``ids``, all within ``lo`` to ``hi``. The literal range prunes
    folders (or files) before anything is read; new batches lie together at the end."""
    return df.filter(F.col(BATCH).between(lo, hi)).join(ids, BATCH, "left_semi")


def write_rollups_incremental(spark: SparkSession, txs: DataFrame, blocks: DataFrame,
                              labels: DataFrame, out_path: str,
                              mempool: DataFrame | None = None, **extend_kw) -> DataFrame:
    """Q29 (batch): label new block batches and append them to ``out_path``.

    The ids are computed once and stored under the checkpoint folder; with nothing
    pending no data is read. Returns the pending-batch frame that was processed."""
    path = scratch_path(spark, "pending")
    pending_batches(txs, blocks, done_batches(spark, out_path)).write.parquet(path)
    todo = spark.read.schema(f"{BATCH} bigint").parquet(path)
    lo, hi = id_range(todo)
    if lo is None:
        return todo
    t, b = only_batches(txs, todo, lo, hi), only_batches(blocks, todo, lo, hi)
    out = rollup_transactions(t, b, labels, mempool, **extend_kw)
    write_batches(out, out_path)
    mark_finished(todo, out_path)
    return todo


def commits(todo: DataFrame, per_commit: int):
    """The rows of ``todo`` (one per batch) in lists of at most ``per_commit``, by batch."""
    after = None
    while True:
        part = todo if after is None else todo.filter(F.col(BATCH) > after)
        rows = part.orderBy(BATCH).limit(per_commit).collect()
        if not rows:
            return
        yield rows
        after = rows[-1][BATCH]


def process_new_batches(spark: SparkSession, txs_path: str, blocks_path: str, labels: DataFrame, out_path: str,
                        mempool: DataFrame | None = None, per_commit: int = 1000, refresh: bool = False,
                        **extend_kw) -> DataFrame:
    """Q29 (batch) over dataset folders: label the batches that both hold and the table lacks.

    Batches are found in the file listings and in the records of earlier commits, so no
    job runs over the rows to find them, and with nothing pending no data file is opened.
    At most ``per_commit`` batches are read, written and recorded at a time: a lost job
    repeats one commit at most. With ``refresh`` batches whose input files changed are
    written again. Returns the states of the batches that were done."""
    path = scratch_path(spark, "pending")
    pending_states(spark, common_batches(spark, txs_path, blocks_path), out_path, refresh).write.parquet(path)
    todo = spark.read.parquet(path)
    for rows in commits(todo, per_commit):
        ids = [r[BATCH] for r in rows]
        t, b = read_batches(spark, txs_path, ids), read_batches(spark, blocks_path, ids)
        write_batches(rollup_transactions(t, b, labels, mempool, **extend_kw), out_path)
        record(spark.createDataFrame(rows, todo.schema), out_path)
    return todo


def copy_batches(spark: SparkSession, src: str | DataFrame, out_path: str, columns: list[str] | None = None,
                 per_commit: int = 1000) -> DataFrame:
    """Pass-through copy of a batched dataset (or some of its columns), skipping
    batches present. Of a folder, the batches come from its listing: with nothing pending
    no data is read and nothing is written. Of a frame, they come from its rows."""
    path = scratch_path(spark, "copying")
    folder = isinstance(src, str)
    states = batch_states(batch_files(spark, src)) if folder else src.select(BATCH).distinct()
    pending_states(spark, states, out_path).write.parquet(path)
    todo = spark.read.parquet(path)
    for rows in commits(todo, per_commit):
        ids = [r[BATCH] for r in rows]
        df = read_batches(spark, src, ids) if folder else src.filter(F.col(BATCH).isin(ids))
        write_batches(df.select(*dict.fromkeys([*(columns or df.columns), BATCH])), out_path)
        record(spark.createDataFrame(rows, todo.schema), out_path)
    return todo


def combine_files(spark: SparkSession, src: str, dst: str,
                  target_file_bytes: int = DEFAULT_FILE_BYTES,
                  max_records_per_file: int | None = None,
                  compression: str = "zstd") -> None:
    """Compact a folder of many small files.

    The reference combines everything into one file (one writer task). Here
    the file count follows the input size (``target_file_bytes`` each), so the
    write stays parallel at any scale; ``max_records_per_file`` caps rows."""
    size = list_files(spark, src).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / target_file_bytes))
    w = spark.read.parquet(src).repartition(n).write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.option("compression", compression).parquet(dst)
