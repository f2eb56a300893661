"""Helpers shared by the operators of this subpackage.

Conventions of all operators: a null id sorts before every other id and is one
document key of its own; a null text is an empty text; input columns beyond the
named ones are ignored, so clashing names do no harm; an empty table gives an
empty result with the same schema.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.session import checkpoint_dir

#: ASCII white space, the word separators of all contracts.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NULL_ID = -(2**63)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    Where the setting is absent, a local session gets a private folder; on a
    cluster that folder would not be shared, so there it is an error.
    """
    return f"{checkpoint_dir(spark).rstrip('/')}/llm"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, text): the id with null as the smallest value, the text with null as empty."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def real_id(did: Column) -> Column:
    """The id as the caller gave it."""
    return F.nullif(did, F.lit(NULL_ID))


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` rows in an Arrow batch of this session: whole texts travel in them, and what a
    Python worker holds grows with a batch. A smaller setting of the session's own stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def release() -> None:
    """Give what a finished task no longer uses back to the system: Python workers wait idle for the next stage."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node.

    Alternating star contraction: in each round every node hangs its larger, then
    its smaller neighbours on the smallest node it knows. Both halves are a minimum
    per node, combined before the shuffle, joined back to the edges; the joined
    side has one row per node, so a hot node is split by the skew join. The edges
    of each round are written to the shared folder. Rounds grow with the logarithm
    of the longest chain.
    """
    edges = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sig = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = materialize(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "edges")
        new = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if tuple(new) == sig:
            break
        sig = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
