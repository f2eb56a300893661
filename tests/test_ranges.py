"""The range index: block ranges and the latest block become batches before data is read."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from chainlens.plans import ranges as R
from chainlens.plans.jobs import write_batches


def dataset(spark, path, batches=6):
    df = spark.range(batches * 100).select(F.col("id").alias("block_number"), (F.col("id") % 7).alias("v"),
                                           F.floor(F.col("id") / 100).cast("bigint").alias("block_batch"))
    write_batches(df, path)


def spoil(path, batches):
    """Data files of these batches cannot be read any more; their listing stays as it is."""
    for b in batches:
        for f in Path(path, f"block_batch={b}").glob("*.parquet"):
            was = f.stat()
            f.write_bytes(b"x" * was.st_size)
            os.utime(f, ns=(was.st_atime_ns, was.st_mtime_ns))


def numbers(df):
    return sorted(r.block_number for r in df.select("block_number").collect())


def test_only_batches_of_the_range_are_read(spark, tmp_path):
    path = str(tmp_path / "blocks")
    dataset(spark, path)
    R.index_ranges(spark, path)
    spoil(path, [0, 1, 4])
    assert numbers(R.select_block_range(spark, path, 250, 310)) == list(range(250, 311))
    assert numbers(R.select_block_range(spark, path, 599)) == [599]
    assert numbers(R.select_block_range(spark, path, 500, 99999)) == list(range(500, 600))
    assert numbers(R.select_block_range(spark, path, latest=True)) == [599]


def test_open_ends_and_empty_ranges(spark, tmp_path):
    path = str(tmp_path / "blocks")
    dataset(spark, path, 3)
    R.index_ranges(spark, path)
    assert numbers(R.select_block_range(spark, path)) == list(range(300))
    assert numbers(R.select_block_range(spark, path, hi=99)) == list(range(100))
    none = R.select_block_range(spark, path, 1000, 2000)
    assert none.count() == 0 and set(none.columns) == {"block_number", "v", "block_batch"}
    assert R.select_block_range(spark, path, 20, 10).count() == 0


def test_stale_or_missing_index_loses_no_rows(spark, tmp_path):
    path = str(tmp_path / "blocks")
    dataset(spark, path, 3)
    assert numbers(R.select_block_range(spark, path, 150, 160)) == list(range(150, 161))  # no index yet
    R.index_ranges(spark, path)
    more = spark.createDataFrame([(1000, 1, 9), (5, 1, 1)], "block_number long, v long, block_batch long")
    more.write.mode("append").partitionBy("block_batch").parquet(path)  # a new batch, and one that changed
    assert numbers(R.select_block_range(spark, path, latest=True)) == [1000]
    assert numbers(R.select_block_range(spark, path, 5, 5)) == [5, 5]
    R.index_ranges(spark, path)
    known = {r.block_batch: (r.first_block, r.last_block) for r in R.block_ranges(spark, path).collect()}
    assert known == {0: (0, 99), 1: (5, 199), 2: (200, 299), 9: (1000, 1000)}
    spoil(path, [2])
    assert numbers(R.select_block_range(spark, path, 5, 5)) == [5, 5]
    assert numbers(R.select_block_range(spark, path, latest=True)) == [1000]


def test_a_batch_of_null_blocks_is_indexed_once(spark, tmp_path):
    path = str(tmp_path / "blocks")
    df = spark.createDataFrame([(None, 0), (7, 1)], "block_number long, block_batch long")
    write_batches(df, path)
    R.index_ranges(spark, path)
    assert R.block_ranges(spark, path).filter("first_block is null").count() == 0
    assert numbers(R.select_block_range(spark, path, 0, 10)) == [7]
    assert R.select_block_range(spark, path, latest=True).count() == 1


def test_many_batches_are_pruned_by_their_range(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "blocks")
    dataset(spark, path)
    R.index_ranges(spark, path, per_commit=2)
    spoil(path, [0, 5])
    monkeypatch.setattr(R, "MOST_FOLDERS", 2)
    assert numbers(R.select_block_range(spark, path, 100, 499)) == list(range(100, 500))
