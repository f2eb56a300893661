"""Corpus pipeline: stages (name, function) over the documents table.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. ``run`` writes each stage to the shared folder and
reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlens.llm.common import NULL_ID, materialize
from chainlens.llm.decontam import leaks
from chainlens.llm.line_dedup import apply_bitmaps, line_bitmaps
from chainlens.llm.sentencepiece_lattice import encode
from chainlens.llm.simhash_dedup import simhash_groups
from chainlens.llm.toxicity import toxicity


def _key(docs: DataFrame) -> DataFrame:
    """(row, did, th): every row as a struct, so that no column name can clash, its id and the hash of its text."""
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))


def _without(docs: DataFrame, bad: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` whose (did, th) is not in ``bad``."""
    return _key(docs).join(materialize(bad.distinct(), name), ["did", "th"], "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scored.where("predicted = 1").select("did", "th"), "toxic")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others keep; n_chars follows the text."""
    out = apply_bitmaps(docs, line_bitmaps(docs))
    shorter = F.col("row").withField("text", F.col("kept")).withField("n_chars", F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return out.select(F.when(F.col("n_dropped") > 0, shorter).otherwise(F.col("row")).alias("row")).select("row.*")


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (3-word shingles, 2 bits): the smallest id, then the smallest
    hash of the text; of rows equal in both, the one with the least hash. Documents whose text was
    emptied before stay one group like any other. Null ids, and the texts of a repeated id, are told
    apart by the text."""
    groups = simhash_groups(docs, shingle=3, max_bits=2)
    keep = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("did"), F.min("th").alias("th"))
    kept = _key(docs).join(materialize(keep.select("did", "th"), "survivors"), ["did", "th"], "left_semi")
    return kept.groupBy("did", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("did"), "th"), "leaks")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip, cost, second_cost): the best segmentation of every document
    with the cost of the runner-up, decoded back as a check."""
    out = encode(docs, n=2)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip",
                      F.round("cost", 4).alias("cost"), F.round(F.get("others", F.lit(0))["cost"], 4).alias("second_cost"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", tokenize),
]

#: hashing, models and the piece lattice are beyond SQL; tests compare with a brute-force run
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
