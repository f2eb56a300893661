"""Block-batched parquet datasets.

The surveyed jobs store one parquet file per block range and pair the
transaction and block files by the range in their names. Here a dataset is a
folder read in one scan; the batch is a column (``block_batch``), taken from a
``block_batch=N`` partition folder when present, else parsed from the file name.
File listings are DataFrames too (``binaryFile`` source without the content
column), so nothing is listed or looped over on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlens.constants import BATCH_END_PATTERN, BATCH_RANGE_PATTERN

BATCH = "block_batch"

FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


def batch_of_filename(name: Column) -> Column:
    """The block batch index is the number after ``to_``; null if absent."""
    return F.nullif(F.regexp_extract(name, BATCH_END_PATTERN, 1), F.lit("")).cast("bigint")


def batch_range_of_filename(name: Column) -> Column:
    """The ``<start>_to_<end>`` label after a double underscore; null if absent."""
    return F.nullif(F.regexp_extract(name, BATCH_RANGE_PATTERN, 1), F.lit(""))


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset folder exists (a metadata-only listing; no data read)."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
             .option("recursiveFileLookup", "true").load(path).select("path").limit(0)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files of a dataset as a DataFrame; a missing folder gives no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], FILE_SCHEMA)
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob)
          .load(path))
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                     "length", "modificationTime")


def sync_batches(files_a: DataFrame, files_b: DataFrame) -> DataFrame:
    """Batches present in both listings, with their file names.
    The key ``batch_end`` is the number after ``to_`` (the batch's last block).

    Fixes kept from the survey: names without a batch are dropped (the
    reference could pair two such names under the key None), and several files
    of one batch are all kept (a batch is a partition, not a single file)."""
    def per_batch(files: DataFrame, side: str) -> DataFrame:
        return (files.withColumn("batch_end", batch_of_filename(F.col("file_name")))
                     .filter(F.col("batch_end").isNotNull())
                     .groupBy("batch_end")
                     .agg(F.sort_array(F.collect_set("file_name")).alias(f"files_{side}")))
    return per_batch(files_a, "a").join(per_batch(files_b, "b"), "batch_end", "inner")


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a dataset folder; add ``block_batch`` from file names unless
    it is a partition column. A missing folder gives an empty frame when a
    schema is given."""
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if BATCH not in df.columns:
        df = df.withColumn(BATCH, batch_of_filename(F.col("_metadata.file_name")))
    return df.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def select_blocks(df: DataFrame, lo: int | None = None, hi: int | None = None,
                  latest: bool = False) -> DataFrame:
    """Inclusive block range ``lo:hi``; open ends allowed; ``latest``
    keeps the highest block (a scalar subquery, not a collect)."""
    b = F.col("block_number")
    if latest:
        return df.filter(b == df.select(F.max("block_number")).scalar())
    if lo is not None:
        df = df.filter(b >= lo)
    if hi is not None:
        df = df.filter(b <= hi)
    return df


def batch_file_name(dataset: str, batch: Column, blocks_per_batch: int) -> Column:
    """File name of a batch in the extractor's layout:
    ``<dataset>__<start>_to_<end>.parquet`` (zero-padded to 8 digits)."""
    start = batch * F.lit(blocks_per_batch)
    end = start + F.lit(blocks_per_batch - 1)
    return F.format_string(f"{dataset}__%08d_to_%08d.parquet", start, end)


def sequencer_labels_table(spark: SparkSession) -> DataFrame:
    """The rollup sequencer label dimension (8 fixed rows) as a DataFrame."""
    from chainlens.constants import SEQUENCER_ADDRESSES, SEQUENCER_NAMES

    return spark.createDataFrame(list(zip(SEQUENCER_ADDRESSES, SEQUENCER_NAMES)),
                                 "sequencer_addresses string, sequencer_names string")
