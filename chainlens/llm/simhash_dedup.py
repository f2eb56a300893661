"""SimHash near-dedup by anchor-point covering.

Fingerprints are linked when they differ in at most ``max_bits`` bits. The anchors
are the codewords of the perfect Hamming code of length 63 (covering radius 1, bit
63 is left out of the code and compared afterwards). Two fingerprints within
``max_bits`` bits have a midpoint within ceil(max_bits / 2) of both, and the anchor
covering that midpoint is within covering radius plus ceil(max_bits / 2) of both:
replicating every fingerprint to all anchors of that ball (32 for two bits) lets
each pair meet. Fingerprints are made distinct first, so copies, however many, are
one row. Fingerprints of one anchor lie in one ball of radius 2: at most 4,034
distinct ones, whatever the size of the corpus.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import NULL_ID, components, keyed, materialize, real_id, release

#: every byte value as eight byte lanes of one bit each, lane k for bit k
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)
_SHINGLE_SLICE = 1 << 20


def bit_counts(h: np.ndarray) -> np.ndarray:
    """For uint64 hashes: how many have each of the 64 bits set (index 0: lowest bit)."""
    total = np.zeros(64, dtype=np.int64)
    if not len(h):
        return total
    cuts = np.arange(0, len(h), 255)  # 255 ones fit a byte lane
    raw = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, k]], cuts)
        total[8 * k:8 * k + 8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash over word shingles, repeats included; no words: 0."""
    w = text.encode("utf-8").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _SHINGLE_SLICE):
        part = w[at:min(n, at + _SHINGLE_SLICE) + shingle - 1]
        if len(part) < shingle:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        counts += bit_counts(np.fromiter((digest(g, 42) for g in grams), dtype=np.uint64))
    bits = (2 * counts > n)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(did, th long, fp long), one row per input row; ``th`` is the hash of the text."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())], ["did", "th", "fp"])
        release()

    return keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text")).mapInArrow(run, "did long, th long, fp long")


def ball_patterns(radius: int) -> list[list[int]]:
    """For each syndrome 0..63 the bit masks of weight <= radius that turn a word of it into a codeword."""
    table: list[list[int]] = [[] for _ in range(64)]
    for weight in range(radius + 1):
        for bits in combinations(range(1, 64), weight):
            s = 0
            for b in bits:
                s ^= b
            table[s].append(sum(1 << (b - 1) for b in bits))
    return table


def anchors(fp: Column, max_bits: int) -> Column:
    """All codewords within 1 + ceil(max_bits / 2) of the fingerprint's 63 bits."""
    word = fp.bitwiseAND(F.lit((1 << 63) - 1))
    syndrome = F.lit(0)
    for k in range(6):
        mask = sum(1 << (b - 1) for b in range(1, 64) if b >> k & 1)
        syndrome = syndrome + F.bit_count(word.bitwiseAND(F.lit(mask))) % 2 * (1 << k)
    rows = ", ".join("array(" + ", ".join(f"{m}L" for m in masks) + ")" for masks in ball_patterns(1 + (max_bits + 1) // 2))
    return F.transform(F.get(F.expr(f"array({rows})"), syndrome), lambda m: word.bitwiseXOR(m))


def _links(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one anchor."""
    v, root, out = np.unique(members).view(np.uint64), {}, []

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for i in range(len(v) - 1):
        near = np.nonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= max_bits)[0] + i + 1
        for j in near:
            a, b = find(i), find(int(j))
            if a != b:
                root[b] = a
                out.append((int(v[i].view(np.int64)), int(v[j].view(np.int64))))
    return out


def fingerprint_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that span every linked group."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits: 0, 1 or 2 (the ball of a larger distance has thousands of anchors)")
    spread = fps.select("fp", F.explode(anchors(F.col("fp"), max_bits)).alias("anchor"))
    groups = (spread.groupBy("anchor").agg(F.collect_list("fp").alias("members"))
              .where(F.size("members") > 1).select("members"))

    def run(batches):
        for b in batches:
            found = set()
            for m in b.column(0):
                found.update(_links(np.array(m.as_py(), dtype=np.int64), max_bits))
            a, z = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["a", "b"])

    return groups.mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, th long, fp long, root long, component_id): every input row with its fingerprint and near-duplicate group.

    ``component_id`` is the smallest id reachable over links, itself included; as the
    texts of one id may lie in several groups, ``root`` (a fingerprint) is what tells
    groups apart, and ``th`` (the hash of the text) tells rows of one id apart. Texts
    without words (null, empty, white space) have fingerprint zero and are linked like
    any other. Repeated rows come back as often as they came in. Null ids are the
    smallest id and come back as null. An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    # no copy count reaches a shuffle: one row per fingerprint and task at most
    nodes = materialize(rows.groupBy("fp").agg(F.min("did").alias("low")), "simhash-distinct")
    comp = components(fingerprint_links(nodes.select("fp"), max_bits))
    comp = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = comp.groupBy("root").agg(F.min("low").alias("component"))
    named = comp.join(lows, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select(real_id(F.col("did")).alias("doc_id"), "th", "fp", "root",
                                         real_id(F.col("component")).alias("component_id"))


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
