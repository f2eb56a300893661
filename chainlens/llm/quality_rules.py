"""Host-level quality rules, in DataFrame functions only.

Per document: word, symbol, repeated-line and repeated-window counts, all computed
inside the row (no shuffle). Per host: documents that fail a rule, combined before
the shuffle, shrunk towards all hosts by an empirical beta prior. A host whose
shrunk rate is high is distrusted; its verdict joins back to the documents, and
distrusted hosts are held to limits half as wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import SPACE, SPACE_RUN, materialize

#: limits of the document rules, and how much narrower they are for a distrusted host
SYMBOLS_PER_WORD, DUP_LINE_SHARE, WORD_CHARS, STRICT = 0.3, 0.6, (2.0, 15.0), 0.5
DISTRUST_RATE = 0.5


def text_measures(docs: DataFrame, text_col: str = "text", width: int = 8) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words under ``_m`` (a struct).

    Null text: no words. Windows are told by 64-bit hashes of word hashes. Linear in
    the words but for one sort per document that has a repeated window.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("_m", "_t", "_w", "_wh", "_win", "_at", "_st", "_ln")]
    t = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    t = t.withColumn("_w", F.filter(F.split("_t", SPACE_RUN, -1), lambda w: w != ""))
    t = t.withColumn("_wh", F.transform("_w", lambda w: F.xxhash64(w)))
    t = t.withColumn("_win", F.when(F.size("_wh") >= width, F.transform(
        F.sequence(F.lit(1), F.size("_wh") - (width - 1)),
        lambda i: F.xxhash64(F.slice(F.col("_wh"), i, width)))).otherwise(F.array().cast("array<bigint>")))
    t = t.withColumn("_win", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.col("_win"))
                     .otherwise(F.array().cast("array<bigint>")))
    t = t.withColumn("_at", F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    at = F.col("_at")
    twice = F.filter("_at", lambda p, j: F.coalesce(F.get(at, j - 1)["h"] == p["h"], F.lit(False))
                     | F.coalesce(F.get(at, j + 1)["h"] == p["h"], F.lit(False)))
    t = t.withColumn("_st", F.sort_array(F.transform(twice, lambda p: p["i"])))
    st = F.col("_st")
    covered = F.aggregate(F.transform("_st", lambda s, k: F.least(
        F.lit(width), F.coalesce(F.get(st, k + 1) - s, F.lit(width)))), F.lit(0).cast("long"), lambda a, x: a + x)
    t = t.withColumn("_ln", F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    measures = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_ln").cast("long").alias("n_lines"),
        (F.size("_ln") - F.size(F.array_distinct("_ln"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"))
    return t.select(*keep, measures.alias("_m"))


def fails(m: Column, factor: float = 1.0) -> Column:
    """Whether the measures break a document rule with limits ``factor`` as wide."""
    per_word = lambda c: m[c] / F.greatest(m["n_words"], F.lit(1))
    mid, half = sum(WORD_CHARS) / 2, (WORD_CHARS[1] - WORD_CHARS[0]) / 2
    return ((per_word("n_symbols") > SYMBOLS_PER_WORD * factor)
            | (m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)) > DUP_LINE_SHARE * factor)
            | (F.abs(per_word("word_chars") - mid) > half * (1 if factor == 1 else 0.75)))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(mean, strength) of the beta prior by moments over hosts (k failures of n)."""
    s = hosts.agg(F.sum("k").alias("k"), F.sum("n").alias("n"), F.count("*").alias("h"),
                  F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    if not s.n:
        return 0.0, 1.0
    mean = s.k / s.n
    spread = max(0.0, s.kk / s.n - mean * mean)
    between = spread - mean * (1 - mean) * s.h / s.n
    strength = 1e6 if between <= 0 else min(1e6, max(1.0, (mean * (1 - mean) - spread) / between))
    return mean, strength


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host: str | Column = "source") -> DataFrame:
    """(doc_id, host, the measures, base_failed, host_rate, host_distrusted, kept) for every row.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word
    windows. Of the rest a document is kept if it breaks no rule of its host's
    strictness. Null text: no words, base_failed. Null hosts are one host. Repeated
    rows are judged alike and all returned. Empty table: empty result.
    """
    host = F.col(host) if isinstance(host, str) else host
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                      F.col(text_col).alias("text"))
    m = F.col("_m")
    rows = text_measures(src).select(
        "doc_id", "host", "_m",
        ((m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])).alias("base_failed"))
    rows = materialize(rows, "quality-measures")  # the texts are read once
    bad = F.col("base_failed") | fails(m)
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(bad.cast("long")).alias("k"))
    mean, strength = beta_prior(hosts)
    rate = (F.col("k") + mean * strength) / (F.col("n") + strength)
    verdicts = hosts.select("host", rate.alias("host_rate"), (rate > DISTRUST_RATE).alias("host_distrusted"))
    strict = F.when(F.col("host_distrusted"), fails(m, STRICT)).otherwise(fails(m))
    return rows.join(verdicts, "host").select(
        "doc_id", "host", "_m.*", "base_failed", "host_rate", "host_distrusted",
        (~F.col("base_failed") & ~strict).alias("kept"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), host="source")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: list_slice(w, i, i + 7))) AS g
  FROM t WHERE len(w) >= 8),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win),
rep AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, host, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ln) AS n_lines,
         len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols / greatest(n_words, 1) > 0.3 OR n_dup_lines / greatest(n_lines, 1) > 0.6
           OR abs(word_chars / greatest(n_words, 1) - 8.5) > 6.5 AS fails,
         n_symbols / greatest(n_words, 1) > 0.15 OR n_dup_lines / greatest(n_lines, 1) > 0.3
           OR abs(word_chars / greatest(n_words, 1) - 8.5) > 4.875 AS strictly
  FROM m),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed OR fails) AS k FROM f GROUP BY host),
s AS (SELECT sum(k) / sum(n) AS mean, greatest(0, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2) AS spread,
             count(*) / sum(n) AS per FROM h),
p AS (SELECT mean, CASE WHEN spread - mean * (1 - mean) * per <= 0 THEN 1e6
             ELSE least(1e6, greatest(1.0, (mean * (1 - mean) - spread) / (spread - mean * (1 - mean) * per))) END AS strength FROM s),
v AS (SELECT host, (k + mean * strength) / (n + strength) > 0.5 AS distrusted FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT CASE WHEN distrusted THEN strictly ELSE fails END AS kept
FROM f JOIN v USING (host)
"""
