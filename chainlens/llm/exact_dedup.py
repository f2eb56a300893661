"""Exact dedup by a tree merge of sorted digest runs.

Every input partition becomes a run: its distinct digests in order, each with the row
that stays and the number of rows. Partitions are the slots 0 .. FANIN^R - 1 of a
cube. In round k a slot sends each entry to the slot whose k-th digit is the k-th
digit of the digest, and keeps the other digits: so 16 slots exchange their runs, each
gets a sixteenth of every run, sorts what it got and merges it in one stream. After R
rounds (the logarithm of the number of partitions) equal digests have met in one slot,
and each slot holds its even share of the digests, never all of them. A group of
copies, however large, is one entry per slot at every level.

An entry is found by its 64-bit digest and verified by SHA-256 of the same text before
it is merged; digests that agree by chance stay apart. The verdicts of groups of two
or more rows go back down the same tree, so that no join meets a key with more than
FANIN entries, and no task holds the copies of more than one input partition.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import SPACE, keyed, materialize, real_id

FANIN = 16
ENTRY = "slot long, h long, sha binary, chars long, did long, rid long, n long"
KEY = ["slot", "h", "sha"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64) -> DataFrame:
    """(slot, h, sha, chars, did, rid, n = 1) of every row: slot the partition that read it, rid its number.

    ``h``: XXH64 of the text without ASCII white space (its low ``digest_bits`` bits),
    ``sha``: SHA-256 of the same, ``chars``: code points of the text as it is.
    """
    base = keyed(docs, id_col, text_col).select("did", "text", F.char_length("text").cast("long").alias("chars"))
    mask, gone = (1 << digest_bits) - 1, SPACE.encode()

    def run(batches):
        slot, at = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = [t.translate(None, gone) for t in b.column(1).cast(pa.binary()).to_pylist()]
            h = np.array([xxhash.xxh64_intdigest(t) & mask for t in texts], dtype=np.uint64).view(np.int64)
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, slot)), pa.array(h), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 b.column(2), b.column(0), pa.array((slot << 40) + at + np.arange(n)), pa.array(np.ones(n, np.int64))],
                ["slot", "h", "sha", "chars", "did", "rid", "n"])
            at += n

    return base.mapInArrow(run, ENTRY)


def merge_runs(entries: DataFrame) -> DataFrame:
    """One entry for each (slot, h, sha): of the longest text, then smallest id, then row; ``n`` is added up.

    The entries of a slot are dealt to one task, sorted (spilling to disk) and merged in
    one pass that holds a batch of rows and the group that is open.
    """
    def run(batches):
        kept = None  # the open group, a batch of one row
        for b in batches:
            if kept is not None:
                b = pa.concat_batches([kept, b])
            if not b.num_rows:
                continue
            slot, h, n = (b.column(i).to_numpy() for i in (0, 1, 6))
            sha = np.array(b.column(2).to_pylist(), dtype="S32")  # fixed length: trailing zero bytes do not matter
            new = np.ones(b.num_rows, dtype=bool)
            new[1:] = (slot[1:] != slot[:-1]) | (h[1:] != h[:-1]) | (sha[1:] != sha[:-1])
            at = np.nonzero(new)[0]
            out = b.take(pa.array(at))
            out = out.set_column(6, "n", pa.array(np.add.reduceat(n, at)))
            kept = out.slice(len(at) - 1)
            yield out.slice(0, len(at) - 1)
        if kept is not None:
            yield kept

    dealt = entries.repartition("slot").sortWithinPartitions(*KEY, F.desc("chars"), "did", "rid")
    return dealt.mapInArrow(run, ENTRY)


def partner(level: int, fanin: int = FANIN):
    """The slot that an entry goes to in round ``level``: its digit there becomes the digest's."""
    step = fanin ** level
    slot = F.col("slot")
    digit = F.floor(slot / step).cast("long") % fanin
    wanted = F.shiftrightunsigned("h", 1) % (fanin ** (level + 1))  # 63 bits, never negative
    return slot + (F.floor(wanted / step).cast("long") - digit) * step


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fanin: int = FANIN, digest_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``, dropped ones too.

    Texts are equal when they are identical without ASCII white space. Of equal texts
    the row with the most code points stays, then the smallest id (null: smaller than
    any other), then the row that was read first, so one row of each group is ``kept``
    even if rows repeat. ``keep_id`` is its id (null if that is null). Null text: empty,
    equal to white space alone. An empty table gives an empty result.
    """
    rows = materialize(digests(docs, id_col, text_col, digest_bits), "digests")
    slots = rows.agg(F.max("slot")).first()[0]
    rounds = math.ceil(math.log(slots + 1, fanin) - 1e-9) if slots else 0
    levels = [materialize(merge_runs(rows), "run-0")]
    for k in range(rounds):
        levels.append(materialize(merge_runs(levels[k].withColumn("slot", partner(k, fanin))), f"run-{k + 1}"))
    verdict = levels[rounds].where("n > 1").select(*KEY, F.col("did").alias("keep"), F.col("rid").alias("first"), F.col("n").alias("size"))
    for k in reversed(range(rounds)):
        up = verdict.withColumnRenamed("slot", "up")
        verdict = (levels[k].select(*KEY, partner(k, fanin).alias("up")).join(up, ["up", "h", "sha"])
                   .select(*KEY, "keep", "first", "size"))
    out = rows.join(verdict, KEY, "left")
    return out.select(
        real_id(F.col("did")).alias("doc_id"), real_id(F.coalesce("keep", "did")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("first") == F.col("rid"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(k) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents)
WINDOW w AS (PARTITION BY k ORDER BY length(t) DESC, doc_id NULLS FIRST)
"""
