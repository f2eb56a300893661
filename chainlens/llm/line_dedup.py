"""Line dedup over a whole corpus, in DataFrame functions only.

Hashes of normalised lines are range-partitioned by (hash, document) and sorted by
position within each document, so that a hash which a third of all documents hold spans
several partitions, in order. One pass over each sorted run marks the first occurrence of
a hash in a document (a row number over the order, no further exchange). The run a line
lies in is stored with it; within a run, the documents of a hash are counted and the
largest id is found over (run, hash), which is never more than one partition of rows.
A hash that crosses a border of runs is the first or last of its runs, so there are at
most two per run: their counts are added up over runs and handed back as a table of
that size. What goes back to the documents is a compressed bitmap (64-line words that
lose a line), never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import NULL_ID, SPACE, keyed, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    s = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(s) == F.char_length(s)
    return F.when(ascii_only, F.lower(s)).otherwise(F.translate(s, UPPER, LOWER))


def sorted_runs(occ: DataFrame) -> DataFrame:
    """(h1, h2, did, th, pos, first, run): occurrences in runs, ranges of (hash, document) in order
    of position. ``first``: whether the document has the hash for the first time."""
    order = Window.partitionBy("h1", "h2", "did").orderBy("pos", "th")
    ranged = occ.repartitionByRange("h1", "h2", "did")
    return materialize(ranged.withColumn("first", F.row_number().over(order) == 1)
                       .withColumn("run", F.spark_partition_id()), "line-runs")


def doomed(runs: DataFrame, min_docs: int) -> DataFrame:
    """The occurrences that are dropped: their hash is in ``min_docs`` documents or more, and the largest is another."""
    ends = runs.groupBy("run").agg(F.min(F.struct("h1", "h2")).alias("a"), F.max(F.struct("h1", "h2")).alias("z"))
    ends = ends.select("run", F.explode(F.array_distinct(F.array("a", "z"))).alias("h")).select("run", "h.*")
    crossing = materialize(ends.groupBy("h1", "h2").agg(F.count("*").alias("runs")).where("runs > 1").drop("runs"), "line-borders")
    # at most one row per run, and two numbers each: a few megabytes for 100,000 runs
    across = runs.join(F.broadcast(crossing), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(
        F.count_if("first").alias("all_docs"), F.max("did").alias("all_top"))
    across = materialize(across, "line-crossing")
    here = Window.partitionBy("run", "h1", "h2")
    found = runs.withColumns({"docs": F.count_if("first").over(here), "top": F.max("did").over(here)})
    found = found.join(F.broadcast(across), ["h1", "h2"], "left")
    return found.where((F.coalesce("all_docs", "docs") >= min_docs) & (F.coalesce("all_top", "top") != F.col("did"))).select("did", "th", "pos")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: (did, th, words array<struct<word, keep>>).

    ``word`` counts blocks of 64 lines, bit i of ``keep`` is line 64*word+i; blocks
    that keep all lines are left out. A document is told by its id and the hash of
    its text (``th``), so repeated rows get the same bitmap and rows that share an
    id but not the text get their own. Null ids count as one document, the smallest.
    """
    base = keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    lines = base.select("did", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # a line shorter than min_chars has no key that long
    occ = (lines.where(F.char_length("line") >= min_chars)
           .select("did", "th", "pos", line_key(F.col("line")).alias("key"))
           .where(F.char_length("key") >= min_chars)
           .select(F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"), "did", "th", "pos"))
    runs = sorted_runs(occ)
    gone = doomed(runs, min_docs)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)
    return (gone.groupBy("did", "th", F.floor(F.col("pos") / 64).cast("int").alias("word"))
            .agg(F.bitwise_not(F.bit_or(bit)).alias("keep"))
            .groupBy("did", "th")
            .agg(F.sort_array(F.collect_list(F.struct("word", "keep"))).alias("words")))


def dropped_positions(words: Column) -> Column:
    """Sorted line numbers whose bit is clear."""
    per_word = F.transform(words, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["keep"], b) == 0),
        lambda b: w["word"] * 64 + b))
    return F.coalesce(F.flatten(per_word), F.array().cast("array<int>"))


def _kept_lines(lines: Column, gone: Column) -> Column:
    """Lines between the dropped ones, as slices: linear in lines plus drops."""
    cuts = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda j: F.slice(
        lines, F.get(cuts, j - 1) + 2, F.get(cuts, j) - F.get(cuts, j - 1) - 1))
    return F.flatten(pieces)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row of ``docs`` as a struct (so that no name can
    clash), its lines before and how many go, and the text of those that stay."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    base = docs.select(F.struct("*").alias("row"), F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.coalesce(quoted(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    out = base.join(bitmaps, ["did", "th"], "left")
    out = out.withColumns({"lines": F.split("text", "\n", -1), "gone": dropped_positions(F.col("words"))})
    kept = F.when(F.col("words").isNull(), F.col("text")).otherwise(
        F.array_join(_kept_lines(F.col("lines"), F.col("gone")), "\n"))
    return out.select("row", F.size("lines").cast("long").alias("n_lines"),
                      F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every row of ``docs``, its text without repeated lines.

    A key (line trimmed and lower-cased) of at least ``min_chars`` code points that at
    least ``min_docs`` documents hold loses all its lines except in the largest id
    holding it. Null or empty text: one empty line, nothing dropped. An empty table
    gives an empty result. Repeated rows are one document.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = apply_bitmaps(src, line_bitmaps(src, "doc_id", "text", min_chars, min_docs), "doc_id", "text")
    return out.select("row.doc_id", "n_lines", "n_dropped", "kept")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS t
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
keyed AS (SELECT doc_id, i, line, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
dup AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
        GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT y.doc_id, y.i, y.line, dup.k IS NOT NULL AND y.doc_id <> dup.keeper AS gone
           FROM keyed y LEFT JOIN dup ON y.k = dup.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
