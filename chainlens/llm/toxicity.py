"""Toxicity by nearest labelled examples.

A bounded sample of labelled rows gives the examples. All their terms (words, and the
five-letter starts of longer words) are indexed; idf is counted over every document of
the table, and a term that label 1 favours weighs more, by its likelihood ratio over
distinct example clusters, so that groups of copies count once. Examples are unit TF-IDF
vectors in an inverted index with block maxima. Every document finds its exact nearest
examples by cosine: the blocks of highest bound give a k-th best, and only blocks whose
bound reaches it are worked out, in single precision; the examples that may be among the
nearest within its rounding are worked out again in double precision. Similarity-weighted
votes, shrunk towards the base rate, are calibrated by a monotone fit to the votes that each
quarter of the examples gets from the others; the neighbours themselves are the evidence.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import keyed, materialize, real_id, release, short_batches

#: the sample of labelled rows: at most so many of label 1 and of label 0
MAX_TOXIC, MAX_CLEAN = 2000, 4000
NEIGHBOURS, BLOCK, SHRINK, THRESHOLD = 15, 64, 0.02, 0.3
#: letters of a word's start that is a term of its own; the likelihood ratio (one in twenty by chance) that weighs nothing
START, CHANCE = 5, 3.84
#: parts of the sample, each scored by the others for the calibration
FOLDS = 4
#: blocks that a search visits to learn a k-th best cosine; queries that are searched together; terms that are common
FEW, TOGETHER, COMMON = 3, 256, 1024
#: words whose ids a task keeps; bytes of text whose words are looked up together; terms of queries that are searched together
SEEN, SLICE, HELD = 100_000, 1 << 21, 1 << 18
#: bytes to bytes: ASCII letters and whatever is beyond ASCII stay, the rest is a space
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> Counter:
    """Counts of the words (lower case; every ASCII byte that is no letter separates)."""
    words = Counter(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).decode("utf-8", "surrogatepass").split(" "))
    words.pop("", None)
    return words


def terms_of(text: str) -> Counter:
    """Counts of the words and of the starts of longer words."""
    words = words_of(text)
    for w, n in list(words.items()):
        if len(w) > START:
            words["^" + w[:START]] += n
    return words


def cluster_key(text: str) -> int:
    """The least hash of the 3-word shingles: equal for most near copies."""
    w = text.split()
    return min((xxhash.xxh64_intdigest(" ".join(w[k:k + 3])) for k in range(max(1, len(w) - 2))), default=0) >> 1


def held_out(did):
    """Whether crc32 of the id as text leaves 2 when divided by 4 (null id: no)."""
    return F.coalesce(F.crc32(real_id(did).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "toxic") -> tuple[DataFrame, dict]:
    """(did, text, y, c) of at most MAX_TOXIC + MAX_CLEAN labelled rows outside the held-out part, and class sizes.

    Rows are taken by the order of the hash of id and text. Of several labels of an id
    the largest counts; null labels do not. ``c`` tells clusters of copies.
    """
    known = (labels.select(F.col(label_id).cast("long").alias("did"), F.col(label).cast("int").alias("y"))
             .where("did is not null and y is not null").where(~held_out(F.col("did")))
             .groupBy("did").agg(F.max("y").alias("y")))
    known = known.join(docs.select("did").distinct(), "did", "left_semi")
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).where("y in (0, 1)").collect()}
    rows = None
    for y, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        picked = known.where(F.col("y") == y).orderBy(F.xxhash64("did"), "did").limit(most)
        # bounded by ``most`` rows of two numbers; an id may have any number of texts, so rows are bounded again
        part = docs.join(F.broadcast(picked), "did").dropDuplicates(["did", "text"])
        part = part.orderBy(F.xxhash64("did", "text"), "did").limit(most)
        rows = part if rows is None else rows.unionByName(part)

    def keys(frames):
        for f in frames:
            yield f.assign(text=f.text.astype(object), c=[cluster_key(t) for t in f.text])

    rows = rows.select("did", "text", "y").mapInPandas(keys, "did long, text string, y int, c long")
    return materialize(rows, "toxic-sample"), sizes


def term_counts(rows: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(terms, counts, totals) of the sample: how many clusters of label y and fold f hold each term,
    counts[f, y, term], and how many there are, totals[f, y]. Copies lie in one fold."""
    def explode(frames):
        for f in frames:
            for text, y, c in zip(f.text, f.y, f.c):
                yield pd.DataFrame({"term": pd.Series(list(terms_of(text)), dtype=object), "y": int(y), "c": int(c)})

    seen = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).mapInPandas(explode, "term string, y int, c long")
    cells = [(f, y) for f in range(FOLDS) for y in (0, 1)]
    at = F.col("c") % FOLDS * 2 + F.col("y")
    got = seen.distinct().groupBy("term").agg(*[F.count_if(at == 2 * f + y).alias(f"n{f}{y}") for f, y in cells]).toArrow().sort_by("term")
    counts = np.array([got[f"n{f}{y}"].to_numpy() for f, y in cells], dtype=np.int64).reshape(FOLDS, 2, -1)
    totals = np.zeros((FOLDS, 2), dtype=np.int64)
    for r in rows.select("y", "c").distinct().groupBy("y", (F.col("c") % FOLDS).alias("f")).count().collect():
        totals[r.f, r.y] = r["count"]
    return got["term"].to_pylist(), counts, totals


def document_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(did, th, gaps, counts) of (did, text) rows: the index terms of each text as the steps between their
    ascending numbers and how often they occur, both as bytes of 32-bit numbers. Written once, read twice."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        number, seen = {t: i for i, t in enumerate(shared.value)}, {}
        for whole in batches:
            for lo, n in groups(pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False), len(whole), SLICE):
                b = whole.slice(lo, n)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *packed(*vectors_of(b.column(1).to_pylist(), number, seen))],
                                                 ["did", "th", "gaps", "counts"])
        del number, seen
        release()

    out = docs.withColumn("th", F.xxhash64("text")).select("did", "text", "th").mapInArrow(
        run, "did long, th long, gaps binary, counts binary")
    out = materialize(out, "toxic-vectors")
    shared.destroy()
    return out


def groups(size: np.ndarray, rows: int, most: int):
    """(first row, number of rows) of consecutive rows: at most ``rows`` and of ``most`` in all, or one row alone."""
    end, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(end):
        done = int(end[at - 1]) if at else 0
        n = min(rows, max(1, int(np.searchsorted(end, done + most, "right")) - at))
        yield at, n
        at += n


def spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    end = np.cumsum(count)
    at = np.repeat(start - (end - count), count)
    at += np.arange(len(at))
    return at


def packed(ids: np.ndarray, counts: np.ndarray, size: np.ndarray) -> list[pa.Array]:
    """The columns gaps and counts of ``document_vectors``, of the terms of consecutive texts."""
    cut = np.concatenate([[0], np.cumsum(size)])
    gaps, first = np.diff(ids, prepend=0), cut[:-1][size > 0]
    gaps[first] = ids[first]
    off = pa.py_buffer((4 * cut).astype(np.int32))
    return [pa.Array.from_buffers(pa.binary(), len(size), [None, off, pa.py_buffer(x.astype("<u4"))]) for x in (gaps, counts)]


def unpacked(gaps: pa.Array, counts: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(term ids, counts, number of terms) of rows of ``document_vectors``, one row after the other."""
    def numbers(col):
        col = col.cast(pa.large_binary())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        raw = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
        return raw.view("<u4").astype(np.int64), (off - off[0]) // 4

    steps, cut = numbers(gaps)
    size, total = np.diff(cut), np.concatenate([[0], np.cumsum(steps)])
    return total[1:] - np.repeat(total[cut[:-1]], size), None if counts is None else numbers(counts)[0], size


def document_counts(vectors: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""
    def count(batches):
        df = np.zeros(n_terms + 1, dtype=np.int64)
        for b in batches:
            for lo, n in groups(pc.binary_length(b.column(0)).to_numpy(zero_copy_only=False) // 4, len(b), HELD):
                df += np.bincount(unpacked(b.column(0).slice(lo, n))[0], minlength=n_terms + 1)
            df[-1] += b.num_rows
        at = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["id", "n"])

    got = vectors.select("gaps").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(n_terms + 1, dtype=np.int64)
    df[got["id"].to_numpy()] = got["n"].to_numpy()
    return df[:-1], int(df[-1])


def favour(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """What label 1 adds to a term's weight: the root of its likelihood ratio beyond chance if it
    is commoner in label 1 (a of n1 clusters) than in label 0 (b of n0), else 0."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    if not n1 or not n0:
        return np.zeros(len(a))
    share = n1 / (n1 + n0)
    e1, e0 = (a + b) * share, (a + b) * (1 - share)

    def part(o, e):
        return o * np.log(np.where(o > 0, o, 1.0) / np.where(o > 0, np.maximum(e, 1e-300), 1.0))

    g = 2 * (part(a, e1) + part(b, e0) + part(n1 - a, n1 - e1) + part(n0 - b, n0 - e0))
    return np.sqrt(np.maximum(0.0, np.where(a > e1, g, 0.0) - CHANCE))


def vectors_of(texts: list[str], number: dict, seen: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term ids, counts, number of terms) of the index terms of each text, by id, one text after the other: the terms
    of ``terms_of``, every different word looked up once. ``seen`` keeps the two ids of words met before."""
    if len(seen) > SEEN:
        seen.clear()

    def learn(b):  # the ids of the word and of its start, 0 for none, in one number
        w = b.decode("utf-8", "surrogatepass")
        start = number.get("^" + w[:START], -1) if len(w) > START else -1
        seen[b] = (number.get(w, -1) + 1 << 31) + start + 1
        return seen[b]

    words = pc.split_pattern(pa.array([t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) for t in texts], pa.large_binary()), " ")
    row, coded = pc.list_parent_indices(words).to_numpy().astype(np.int64) << 32, words.flatten().dictionary_encode()
    both = np.fromiter((seen[w] if w in seen else learn(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64, len(coded.dictionary))
    both = both[coded.indices.to_numpy()]
    keys = [(x, x > 0) for x in (both >> 31, both & (1 << 31) - 1)]
    keys = np.sort(np.concatenate([row[known] + x[known] - 1 for x, known in keys]))
    first = np.nonzero(np.diff(keys, prepend=-1))[0]
    counts, keys = np.diff(first, append=len(keys)), keys[first]
    return keys & (1 << 32) - 1, counts, np.bincount(keys >> 32, minlength=len(texts))


def vector(text: str, number: dict) -> tuple[np.ndarray, np.ndarray]:
    """(term ids, counts) of the index terms in a text, by id."""
    return vectors_of([text], number, {})[:2]


def joined(vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term ids, counts, number of terms) of (term ids, counts), one after the other."""
    none = np.zeros(0, np.int64)
    ids, counts = (np.concatenate([v[k] for v in vectors] or [none]) for k in (0, 1))
    return ids.astype(np.int64, copy=False), counts, np.array([len(v[0]) for v in vectors], dtype=np.int64)


class Index:
    """Examples as unit TF-IDF vectors, in blocks of 64: values by term, and the maximum of each common term by block."""

    def __init__(self, examples: list, weight: np.ndarray, class_sizes: dict):
        """examples: (did, y, term ids, counts); weight: idf and more of every term."""
        self.term_weight = np.asarray(weight, dtype=np.float64)
        did, y = (np.array([e[k] for e in examples], dtype=np.int64) for k in (0, 1))
        taken = {k: max(1, int((y == k).sum())) for k in (0, 1)}
        scale = np.array([class_sizes.get(k, 0) / taken[k] for k in (0, 1)])  # rows that an example stands for
        total = float(scale[y].sum())
        self.base = float(scale[y] @ y) / total if total else 0.0
        ids, counts, size = joined([e[2:] for e in examples])
        unit, row = self.unit(ids, counts, size)
        most = np.zeros(len(examples))
        np.maximum.at(most, row, unit)
        best = np.nonzero((unit > 0) & (unit == most[row]))[0][::-1]
        top = np.full(len(examples), -1, dtype=np.int64)
        top[row[best]] = ids[best]  # the first term of the largest value
        order = np.lexsort((did, top))
        order = order[top[order] >= 0]
        self.did, self.y = did[order], y[order]
        self.weight = scale[self.y] / max(scale[1], 1e-9) if scale[1] else np.ones(len(order))
        self.n_blocks = -(-len(order) // BLOCK)
        at = spans((np.cumsum(size) - size)[order], size[order])
        cols, vals = ids[at].astype(np.int32), unit[at]
        known: dict = {}  # equal vectors, to the first of them
        end = np.concatenate([[0], np.cumsum(size[order])]).tolist()
        self.same = np.array([known.setdefault(xxhash.xxh128_digest(cols[a:z].tobytes() + vals[a:z].tobytes()), i)
                              for i, (a, z) in enumerate(zip(end, end[1:]))], dtype=np.int64)
        del ids, counts, unit, at, row, best, known
        row = np.repeat(np.arange(len(order), dtype=np.int32), size[order])
        # the commonest terms stand as columns of a value for each example, the others as lists by term
        held = np.bincount(cols, minlength=len(self.term_weight))
        common = np.argsort(-held, kind="stable")[:min(COMMON, int((held > 0).sum()))]
        self.slot = np.full(len(self.term_weight), -1, dtype=np.int32)
        self.slot[common] = np.arange(len(common))
        at, rare = self.slot[cols], self.slot[cols] < 0
        self.dense, self.rest = np.zeros((2, self.n_blocks * BLOCK, len(common)), dtype=np.float32)
        self.dense[row[~rare], at[~rare]] = vals[~rare]  # and what single precision leaves of each value
        self.rest[row[~rare], at[~rare]] = vals[~rare] - self.dense[row[~rare], at[~rare]]
        self.most = np.ascontiguousarray(self.dense.reshape(self.n_blocks, BLOCK, len(common)).max(axis=1).T)  # their block maxima
        by = np.nonzero(rare)[0]
        by = np.sort((cols[by].astype(np.int64) << 32) + by) & (1 << 32) - 1  # by term, then by example
        self.post, self.post_vals = row[by], vals[by]
        self.post_n = np.where(self.slot < 0, held, 0)
        self.post_at = np.cumsum(self.post_n) - self.post_n
        #: a sum of so many products of single precision, none below 0, is off by less than this share of it
        self.off = (len(common) + 16) * 2.0 ** -24

    def unit(self, ids: np.ndarray, counts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, row numbers) of unit vectors, one after the other."""
        row = np.repeat(np.arange(len(size)), size)
        w = (1 + np.log(counts.astype(np.float64))) * self.term_weight[ids]
        norm = np.sqrt(np.bincount(row, w * w, minlength=len(size)))
        return w / np.where(norm > 0, norm, 1.0)[row], row

    def search_many(self, queries: list, k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (term ids, counts) the (example numbers, cosines) of the k nearest examples with a cosine
        above 0, exactly; ties by number."""
        return self.search(*joined(queries), k) if queries else []

    def search(self, ids: np.ndarray, counts: np.ndarray, size: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search_many`` of queries whose terms stand one after the other.

        Rare terms are added up from their lists. Their largest sum in a block plus what
        the block maxima of the common terms allow bounds every cosine in the block. The
        FEW best blocks of each query give a k-th best cosine; then all blocks whose
        bound reaches it are worked out, each for all queries that need it at once. For common
        terms that is single precision; an example that its rounding (``off``) may leave among
        the k nearest is worked out again in double precision, equal examples once."""
        n, wide, width = len(size), self.n_blocks * BLOCK, len(self.y)
        none = (np.zeros(0, np.int64), np.zeros(0))
        if not wide or not n:
            return [none] * n
        q, row = self.unit(ids, counts, size)
        slot = self.slot[ids]
        at = np.nonzero(slot >= 0)[0]
        common, rare = np.zeros((n, self.dense.shape[1]), dtype=np.float32), np.zeros((n, wide))
        common[row[at], slot[at]] = q[at]
        q_common, slot, q_cut = q[at], slot[at], np.searchsorted(row[at], np.arange(n + 1)).tolist()
        has = np.nonzero(self.post_n[ids])[0]
        start, count, value = self.post_at[ids[has]], self.post_n[ids[has]], q[has]
        cut = np.searchsorted(row[has], np.arange(n + 1)).tolist()
        for i, (a, z) in enumerate(zip(cut, cut[1:])):  # one at a time: the postings of a query stay in the cache
            if a < z:
                at, v = spans(start[a:z], count[a:z]), np.repeat(value[a:z], count[a:z])
                v *= self.post_vals[at]
                rare[i] = np.bincount(self.post[at], v, minlength=wide)
        rare = rare.reshape(n, self.n_blocks, BLOCK)
        bound = common @ self.most + rare.max(axis=2)
        cosine = np.full((n, self.n_blocks, BLOCK), -1.0, dtype=np.float32)
        blocks = self.dense.reshape(self.n_blocks, BLOCK, -1)

        def visit(need):
            for b in np.nonzero(need.any(axis=0))[0].tolist():
                who = np.nonzero(need[:, b])[0]
                who = who if 2 * len(who) < n else slice(None)  # of most queries it costs less to take all
                cosine[who, b] = common[who] @ blocks[b].T + rare[who, b]

        def reach(known):  # the least that may be a k-th best, given cosines of some examples
            last = known.shape[1] - min(k, known.shape[1])
            return np.maximum(np.partition(known, last, axis=1)[:, last:last + 1].astype(np.float64) * (1 - 3 * self.off), 1e-13)

        few = min(FEW, self.n_blocks)
        best, first = np.argpartition(-bound, few - 1, axis=1)[:, :few], np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(first, best, True, axis=1)
        visit(first)
        visit((bound >= reach(np.take_along_axis(cosine, best[:, :, None], axis=1).reshape(n, -1))) & ~first)
        flat, rare = cosine.reshape(n, wide), rare.reshape(n, wide)
        found, which = np.nonzero(flat[:, :width] >= reach(flat))
        cut, out = np.searchsorted(found, np.arange(n + 1)).tolist(), []
        for i in range(n):
            at, mine = which[cut[i]:cut[i + 1]], slice(q_cut[i], q_cut[i + 1])
            once, again = np.unique(self.same[at], return_inverse=True) if len(at) > 2 * k else (at, slice(None))
            c = [np.zeros(0)]
            for lo in range(0, len(once), BLOCK):
                few = once[lo:lo + BLOCK]
                here = np.ix_(few, slot[mine])
                c.append((self.dense[here] + self.rest[here].astype(np.float64)) @ q_common[mine] + rare[i, few])
            c = np.round(np.concatenate(c), 12)[again]
            order = np.lexsort((at, -c))[:k]
            order = order[c[order] > 0]
            out.append((at[order], c[order]))
        return out

    def votes_many(self, queries: list) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(share of label 1 among the neighbours, by squared cosine, shrunk to the base rate; neighbours; cosines)."""
        return self.votes(*joined(queries)) if queries else []

    def votes(self, ids: np.ndarray, counts: np.ndarray, size: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """``votes_many`` of queries whose terms stand one after the other."""
        out = []
        for i, c in self.search(ids, counts, size):
            w = self.weight[i] * c * c
            out.append(((float(w @ self.y[i]) + SHRINK * self.base) / (float(w.sum()) + SHRINK), i, c))
        return out


def calibration(votes: np.ndarray, y: np.ndarray, weight: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray]:
    """(votes, rates): the rate of label 1 as a function of the votes that never falls (pool adjacent
    violators), each pool shrunk to the base rate by one row; between pools it is interpolated."""
    pools: list[list[float]] = []
    for i in np.lexsort((y, votes)).tolist():
        pools.append([weight[i] * y[i], weight[i], weight[i] * votes[i]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([p[2] / p[1] for p in pools])
    return at, np.maximum.accumulate(np.array([(p[0] + base) / (p[1] + 1.0) for p in pools]))


def build_index(docs: DataFrame, rows: DataFrame, sizes: dict) -> tuple[list[str], dict, DataFrame]:
    """(terms, examples, the documents' vectors) of the sample ``rows``: the vectors as flat arrays, idf over ``docs``, and what
    label 1 adds to each term's weight, by all rows (the last row of ``plus``) and without each fold.

    Plain data of some tens of megabytes at most; tasks make indexes of it (``index_of``)."""
    terms, counts, totals = term_counts(rows)
    all_vectors = document_vectors(docs, terms)
    df, n = document_counts(all_vectors, len(terms))
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def vectors(frames):
        number = {t: i for i, t in enumerate(shared.value)}
        for f in frames:
            got = [vector(t, number) for t in f.text]
            yield pd.DataFrame({"did": f.did, "y": f.y, "fold": f.c % FOLDS, "ids": [g[0].astype(np.int32) for g in got],
                                "counts": [g[1].astype(np.int32) for g in got]})

    got = rows.mapInPandas(vectors, "did long, y int, fold long, ids array<int>, counts array<int>").toArrow()
    shared.destroy()
    lists = [[x.values.to_numpy() for x in got[k]] for k in ("ids", "counts")]
    examples = sorted(zip(got["did"].to_pylist(), got["y"].to_pylist(), got["fold"].to_pylist(), *lists),
                      key=lambda e: (e[0], e[1], len(e[3]), e[3].tobytes(), e[4].tobytes()))
    flat = [np.concatenate([e[k] for e in examples]) if examples else np.zeros(0, np.int32) for k in (3, 4)]

    def plus(folds):
        a, b = (counts[folds, y].sum(axis=0) for y in (1, 0))
        return favour(a, b, int(totals[folds, 1].sum()), int(totals[folds, 0].sum()))

    parts = [[g for g in range(FOLDS) if g != f] for f in range(FOLDS)] + [list(range(FOLDS))]
    return terms, {"did": [e[0] for e in examples], "y": [e[1] for e in examples], "fold": [e[2] for e in examples],
                   "at": np.concatenate([[0], np.cumsum([len(e[3]) for e in examples])]).astype(np.int64), "ids": flat[0],
                   "counts": flat[1].astype(np.uint16) if flat[1].max(initial=0) < 1 << 16 else flat[1],
                   "idf": np.log((1 + n) / (1 + df)) + 1e-3,  # a term of all documents keeps a trace of weight
                   "plus": np.array([plus(p) for p in parts]), "sizes": sizes}, all_vectors


def example(examples: dict, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(term ids, counts) of an example."""
    at = slice(examples["at"][i], examples["at"][i + 1])
    return examples["ids"][at], examples["counts"][at]


def index_of(examples: dict, without: int | None = None) -> Index:
    """The index of all examples, or of those of the other folds, weighted by what these say of terms."""
    rows = [(examples["did"][i], examples["y"][i], *example(examples, i)) for i, f in enumerate(examples["fold"]) if f != without]
    plus = examples["plus"][-1 if without is None else without]
    return Index(rows, examples["idf"] * (1 + plus), examples["sizes"])


def fold_votes(spark, examples: dict) -> tuple[np.ndarray, np.ndarray]:
    """(votes, label) of every example, with the index of the other folds; one task for each fold."""
    shared = spark.sparkContext.broadcast(examples)

    def run(frames):
        examples = shared.value  # plain data: executors need no package
        for f in frames:
            for fold in f.id.tolist():
                index, mine = index_of(examples, fold), [i for i, g in enumerate(examples["fold"]) if g == fold]
                for lo, n in groups(np.diff(examples["at"])[mine], TOGETHER, HELD):
                    few = mine[lo:lo + n]
                    got = index.votes_many([example(examples, i) for i in few])
                    yield pd.DataFrame({"votes": [v[0] for v in got], "y": [examples["y"][i] for i in few]})
                del index
                release()

    got = spark.range(0, FOLDS, 1, FOLDS).mapInPandas(run, "votes double, y int").toArrow()
    shared.destroy()
    return got["votes"].to_numpy(), got["y"].to_numpy()


SCORED = ("did long, th long, score double, terms array<string>, "
          "evidence array<struct<doc_id: long, label: int, cosine: double>>")


def scored(vectors: DataFrame, shared) -> DataFrame:
    """SCORED of document vectors with the (terms that label 1 favours by id, examples, calibration or None) in ``shared``."""
    def run(batches):
        terms, examples, fit = shared.value
        idx, plus = index_of(examples), examples["plus"][-1]
        marked = plus > 0
        for whole in batches:
            for lo, n in groups(pc.binary_length(whole.column(2)).to_numpy(zero_copy_only=False) // 4, TOGETHER, HELD):
                b = whole.slice(lo, n)
                ids, counts, size = unpacked(b.column(2), b.column(3))
                score, near, cosines = zip(*idx.votes(ids, counts, size))
                if fit is not None:
                    score = np.interp(score, *fit)
                at = np.nonzero(marked[ids])[0]
                row, marks = np.repeat(np.arange(n), size)[at], ids[at]
                found = pa.array([terms[k] for k in marks[np.lexsort((-plus[marks], row))].tolist()], pa.string())
                cut, i = np.cumsum([0] + [len(x) for x in near]), np.concatenate(near)
                evidence = pa.StructArray.from_arrays([pa.array(idx.did[i]), pa.array(idx.y[i], pa.int32()), pa.array(np.concatenate(cosines))],
                                                      ["doc_id", "label", "cosine"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(score, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), found),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), evidence)], ["did", "th", "score", "terms", "evidence"])
        del idx
        release()

    return vectors.mapInArrow(run, SCORED)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(did, th, doc_id, held_out, score, predicted, terms, evidence) for every row of ``docs``.

    ``terms``: the terms found that label 1 favours, the strongest first; a five-letter
    start has a ``^`` before it. ``evidence``: the nearest examples (doc_id, label,
    cosine). The calibration is fitted to votes for a quarter of the examples by the
    others; afterwards an example is a neighbour of any text, its own among them, so
    that ids are no input of a score. Texts without any term of an example (null and empty ones
    among them) get the calibrated base rate. Without labels every score is 0. Repeated
    rows are scored alike. An empty table gives an empty result. ``did`` and ``th`` tell
    a row by its id (null: the smallest long) and the hash of its text.
    """
    base = keyed(docs, id_col, text_col)
    context = base.sparkSession.sparkContext
    short_batches(base.sparkSession)
    rows, sizes = sample(base, labels, label_id, label)
    terms, examples, vectors = build_index(base, rows, sizes)
    taken = np.bincount(examples["y"], minlength=2) if examples["y"] else np.zeros(2)
    fit = None
    if taken[1]:
        votes, y = fold_votes(base.sparkSession, examples)
        scale = np.array([sizes.get(k, 0) / max(1, taken[k]) for k in (0, 1)])
        fit = calibration(votes, y, (scale / scale[1])[y], sizes[1] / sum(sizes[k] for k in (0, 1) if taken[k]))
    plus = examples["plus"][-1]
    out = scored(vectors, context.broadcast(({int(k): terms[k] for k in np.nonzero(plus > 0)[0]}, {**examples, "plus": plus[None]}, fit)))
    return out.select("did", "th", real_id(F.col("did")).alias("doc_id"), held_out(F.col("did")).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "terms", "evidence")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    out = toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "held_out", "score", "predicted")
