"""Quality classifier by a weak-label model.

Overlapping heuristics vote good, bad or nothing on every document. The corpus is
reduced to counts of vote patterns (at most 3^8 rows), on which expectation-
maximisation estimates how accurate each heuristic is, and so the probability that a
document with such votes is good. These posterior labels train a linear scorer over
hashed byte 4-grams and hashed steps of the measures, on a bounded sample of documents; it then scores every
whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import keyed, materialize, real_id
from chainlens.llm.textscan import Scanner, byte_slices, windows

#: documents the scorer is trained on: at most so many of each posterior side
MAX_SIDE = 2000
HASH_BITS, GRAM, EPOCHS, RATE, RIDGE, THRESHOLD = 16, 4, 120, 0.5, 1e-4, 0.5
#: heuristics: (measure, good up to, bad from); between the two, or without words, no vote
VOTERS = (
    ("symbols", 0.05, 0.3),  # of #*$%&|<> a word
    ("repeated", 0.05, 0.3),  # words in 8-word windows seen before or again
    ("echoes", 0.05, 0.2),  # words equal to the word before
    ("lines", 0.3, 0.6),  # lines equal to another line
    ("capitals", 0.1, 0.4),  # of the letters
    ("shouts", 0.05, 0.3),  # exclamation and question marks a word
    ("signs", 0.05, 0.25),  # of the words: those without a letter
    ("foreign", 0.1, 0.25),  # ASCII bytes in words that are no letters
)


def _lut(chars) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[ord(c) if isinstance(c, str) else c for c in chars]] = True
    return t


_SPACE, _SYMBOL, _SHOUT = _lut(" \t\n\x0b\x0c\r"), _lut("#*$%&|<>"), _lut("!?")
_UPPER, _LOWER = _lut(range(65, 91)), _lut([*range(97, 123), *range(128, 256)])
_NEWLINE = _lut("\n")


def _doubles(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which values occur again in the same row."""
    order = np.lexsort((h, row))
    same = np.zeros(len(h), dtype=bool)
    if len(h) > 1:
        eq = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        same[order[1:]] |= eq
        same[order[:-1]] |= eq
    return same


def measures(data: np.ndarray, off: np.ndarray, words: Scanner, lines: Scanner) -> np.ndarray:
    """(rows, voters) shares, nan for texts without words."""
    n = len(off) - 1
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[off])
    start, end, row = words.words(data, off)
    h = words.hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    count = np.bincount(row, minlength=n)
    echo = np.zeros(len(h), dtype=bool)
    if len(h) > 1:
        echo[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    w = windows(h, 8)
    inside = row[:len(w)] == row[7:] if len(w) else np.zeros(0, bool)
    hit = np.zeros(len(w), dtype=bool)
    if inside.any():
        hit[inside] = _doubles(w[inside], row[:len(w)][inside])
    cover = np.zeros(len(h) + 8, dtype=np.int64)
    cover[:len(w)] += hit
    cover[8:8 + len(w)] -= hit
    covered = np.cumsum(cover)[:len(h)] > 0
    ls, le, lrow = lines.words(data, off)
    lh = lines.hashes(data, ls, le) if len(ls) else np.zeros(0, np.uint64)
    twin = _doubles(lh, lrow)
    upper, lower = per(_UPPER[data]), per(_LOWER[data])
    letters = np.concatenate([[0], np.cumsum((_UPPER | _LOWER)[data], dtype=np.int64)])
    sign = letters[end] == letters[start]
    black = per(~_SPACE[data])
    safe = np.maximum(count, 1)
    out = np.stack([
        per(_SYMBOL[data]) / safe, np.bincount(row[covered], minlength=n) / safe, np.bincount(row[echo], minlength=n) / safe,
        np.bincount(lrow[twin], minlength=n) / np.maximum(np.bincount(lrow, minlength=n), 1),
        upper / np.maximum(upper + lower, 1), per(_SHOUT[data]) / safe,
        np.bincount(row[sign], minlength=n) / safe, (black - upper - lower) / np.maximum(black, 1)], axis=1)
    out[count == 0] = np.nan
    return out


def pattern(shares: np.ndarray) -> np.ndarray:
    """Votes as a number in base 3: 0 nothing, 1 bad, 2 good."""
    code = np.zeros(len(shares), dtype=np.int64)
    for k, (_, good, bad) in enumerate(VOTERS):
        x = shares[:, k]
        code += 3 ** k * np.where(x <= good, 2, np.where(x >= bad, 1, 0))
    return code


def weak_model(patterns: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of 'good' by pattern, and per voter P(vote right | it votes) for (bad, good) documents.

    Each voter has two accuracies, shrunk by a weak prior. The heuristics are made not to
    fire on good documents (their false alarms are held to 5 %), while a bad document
    trips only some of them; this also keeps the two classes from changing places. The
    share of good documents is learned too.
    """
    codes = np.array(sorted(patterns), dtype=np.int64)
    if not len(codes):
        return {}, np.full((len(VOTERS), 2), 0.8)
    n = np.array([patterns[int(c)] for c in codes], dtype=float)
    votes = np.stack([codes // 3 ** k % 3 for k in range(len(VOTERS))], axis=1)
    right, good = np.tile([0.4, 0.99], (len(VOTERS), 1)), 0.8
    for _ in range(rounds):
        like = np.log(np.array([1 - good, good]))[None, :].repeat(len(codes), 0)
        for k in range(len(VOTERS)):
            for y in (0, 1):
                p = right[k, y]
                like[:, y] += np.where(votes[:, k] == 0, 0.0, np.log(np.where(votes[:, k] == y + 1, p, 1 - p)))
        post = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -500, 500)))
        by = np.stack([n * (1 - post), n * post], axis=1)
        good = min(0.99, max(0.01, by[:, 1].sum() / n.sum()))
        for k in range(len(VOTERS)):
            for y in (0, 1):
                right[k, y] = (by[votes[:, k] == y + 1, y].sum() + (4, 9.9)[y]) / (by[votes[:, k] > 0, y].sum() + 10)
        right[:, 0] = np.clip(right[:, 0], 0.1, 0.999)
        right[:, 1] = np.clip(right[:, 1], 0.95, 0.999)
    return dict(zip(codes.tolist(), post.tolist())), right


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Hashes of all 4-grams of bytes."""
    d = data.astype(np.uint32)
    n = max(0, len(d) - GRAM + 1)
    g = sum(d[k:k + n] << np.uint32(8 * k) for k in range(GRAM))
    return ((g * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)).astype(np.int64) if n else np.zeros(0, np.int64)


_STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8])
_WEIGHTS = (1 << HASH_BITS) + 8 * len(VOTERS)


def step_ids(shares: np.ndarray) -> np.ndarray:
    """(rows, voters): the weight of each measure's step; texts without words are in the first."""
    return (1 << HASH_BITS) + 8 * np.arange(len(VOTERS))[None, :] + np.digitize(np.nan_to_num(shares), _STEPS)


def train(ids: np.ndarray, val: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer: full gradient, with a step size of its own for each weight.

    Row i has the hash ids and shares at[i]:at[i+1], target y[i] and weight[i]. The
    gradient is summed over blocks of rows, so that memory stays with the input's.
    """
    w, bias = np.zeros(_WEIGHTS), 0.0
    if not len(y):
        return w, bias
    weight = weight / weight.sum()
    seen, bseen = np.full(_WEIGHTS, 1e-10), 1e-10
    blocks = [(lo, min(lo + 256, len(y))) for lo in range(0, len(y), 256)]
    for _ in range(EPOCHS):
        g, gb = RIDGE * w / len(y), 0.0
        for lo, hi in blocks:
            i, v = ids[at[lo]:at[hi]], val[at[lo]:at[hi]]
            z = np.add.reduceat(v * w[i], at[lo:hi] - at[lo]) + bias
            err = weight[lo:hi] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[lo:hi])
            g += np.bincount(i, weights=v * np.repeat(err, np.diff(at[lo:hi + 1])), minlength=len(w))
            gb += float(err.sum())
        seen += g * g
        w -= RATE * g / np.sqrt(seen)
        bseen += gb * gb
        bias -= RATE * gb / np.sqrt(bseen)
    return w, float(bias)


def _scanners() -> tuple[Scanner, Scanner]:
    return Scanner((~_SPACE).astype(np.uint8)), Scanner((~_NEWLINE).astype(np.uint8))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for every row of ``docs``.

    ``votes``: the pattern in base 3, ``posterior``: the weak model's probability of
    good, ``score``: the trained scorer's, ``kept``: score >= 0.5. Texts without words
    (null, empty) get no votes and the posterior of such documents. Repeated rows are
    judged alike. An empty table gives an empty result.
    """
    base = keyed(docs, id_col, text_col)

    def vote(batches):
        words, lines = _scanners()
        for b in batches:
            codes = [pattern(measures(data, off, words, lines)) for _, data, off in byte_slices(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.concatenate(codes) if codes else [], pa.int64())], ["did", "th", "votes"])

    hashed = base.withColumn("th", F.xxhash64("text"))
    votes = materialize(hashed.mapInArrow(vote, "did long, th long, votes long"), "quality-votes")
    post, _ = weak_model({r.votes: r["count"] for r in votes.groupBy("votes").count().collect()})
    table = base.sparkSession.createDataFrame([(int(k), float(v)) for k, v in post.items()], "votes long, posterior double")
    table = F.broadcast(table)  # at most 3^8 rows
    judged = votes.join(table, "votes")
    weights = fit(hashed, judged)
    shared = base.sparkSession.sparkContext.broadcast(weights)

    def score(batches):
        w, bias = shared.value
        words, lines = _scanners()
        for b in batches:
            out = []
            for _, data, off in byte_slices(b.column(1)):
                steps = w[step_ids(measures(data, off, words, lines))].mean(axis=1)
                hits = np.concatenate([[0.0], np.cumsum(w[gram_ids(data)])])
                lo = np.minimum(off[:-1], len(hits) - 1)
                hi = np.maximum(lo, np.minimum(off[1:] - GRAM + 1, len(hits) - 1))
                out.append((hits[hi] - hits[lo]) / np.maximum(hi - lo, 1) + steps + bias)
            z = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9))],
                                             ["did", "th", "score"])

    scored = hashed.mapInArrow(score, "did long, th long, score double")
    seen = judged.dropDuplicates(["did", "th"]).select("did", "th", "votes", "posterior")
    return scored.join(seen, ["did", "th"]).select(
        real_id(F.col("did")).alias("doc_id"), "votes", "posterior", "score", (F.col("score") >= THRESHOLD).alias("kept"))


def fit(hashed: DataFrame, judged: DataFrame) -> tuple[np.ndarray, float]:
    """The scorer, from at most MAX_SIDE documents of each side of the posterior, by the order of a hash."""
    sides = {r.side: r["count"] for r in judged.groupBy((F.col("posterior") >= 0.5).alias("side")).count().collect()}
    picked = None
    for side in (True, False):
        part = (judged.where((F.col("posterior") >= 0.5) == F.lit(side)).select("did", "th", "posterior").distinct()
                .orderBy(F.xxhash64("th", "did"), "did", "th").limit(MAX_SIDE))
        picked = part if picked is None else picked.unionByName(part)
    rows = hashed.join(F.broadcast(picked), ["did", "th"]).dropDuplicates(["did", "th"])  # bounded by 2 * MAX_SIDE

    def grams(batches):
        words, lines = _scanners()
        for b in batches:
            for k in range(b.num_rows):
                data = np.frombuffer((b.column(0)[k].as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                g = gram_ids(data)
                ids, n = np.unique(g, return_counts=True)
                steps = step_ids(measures(data, np.array([0, len(data)]), words, lines))[0]
                ids = np.concatenate([ids, steps])
                share = np.concatenate([n / max(1, len(g)), np.full(len(steps), 1 / len(steps))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.astype(np.int32)], pa.list_(pa.int32())), pa.array([share.astype(np.float32)], pa.list_(pa.float32())),
                     b.column(1).slice(k, 1), b.column(2).slice(k, 1)], ["ids", "val", "posterior", "did"])

    got = (rows.select("text", "posterior", "did").mapInArrow(grams, "ids array<int>, val array<float>, posterior double, did long")
           .toArrow().combine_chunks().sort_by([("did", "ascending"), ("posterior", "ascending")]).combine_chunks())
    post = got["posterior"].to_numpy()
    if not len(post):
        return train(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64), post, post)
    flat, val = got["ids"].chunk(0).flatten().to_numpy(), got["val"].chunk(0).flatten().to_numpy()
    at = np.concatenate([[0], np.cumsum(got["ids"].chunk(0).value_lengths().to_numpy())])
    good = post >= 0.5
    scale = np.where(good, sides.get(True, 0) / max(1, good.sum()), sides.get(False, 0) / max(1, (~good).sum()))
    return train(flat, val, at, post, scale)


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
