"""Runs of words with a period, by a branching-tandem test over an enhanced suffix array.

For the words of many documents at once (numpy arrays, one slice of texts at a time):

* a suffix array by prefix doubling; the ranks of every level are kept. A symbol is a
  word of one document, so no interval spans two documents;
* longest common prefixes of neighbours from the same ranks, and the LCP intervals as
  pairs (previous smaller, next smaller) of each entry: no tree is built;
* in each interval of depth l, the suffixes i of all children but the largest ask
  whether suffix i+l or i-l lies in the interval (its inverse suffix array value does)
  but in another child. Then two copies of a word sequence of length l stand side by
  side and cannot be moved right by one word: a branching tandem repeat;
* the repeat is rotated to the left as long as it stays a square (a common suffix, from
  the ranks by halving), which gives the whole run with that period. Of the periods
  found for one stretch the smallest is its period.

Each suffix lies in at most log2(n) smaller children, so the work is n log n for a text
of n words. Words that occur too rarely to be in a run (a run of exponent e holds each
of its words e times) cut the text into pieces beforehand; that loses nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import NULL_ID, keyed, real_id

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: words that are searched together (a longer text is searched alone)
SLICE_WORDS = 1 << 18
_BLOCK = 32


def suffix_ranks(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by level): two suffixes have the same rank at level k if their
    first 2^k symbols agree; at the last level all ranks differ. The last symbol must be unique."""
    order = np.argsort(s, kind="stable")
    sa = order.copy()
    rank = np.empty(len(s), dtype=np.int64)

    def number(where, base, same):
        """Give the suffixes ``where`` (sorted, of equal old rank ``base``) the place of the first equal one."""
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(where))))
        place = base + np.arange(len(where)) - _group_start(base)
        rank[where] = place[first]
        sa[place] = where
        alone = ~same
        alone[:-1] &= ~same[1:]
        return where[~alone]

    ss = s[order]
    same = np.zeros(len(s), dtype=bool)
    same[1:] = ss[1:] == ss[:-1]
    active = number(order, np.zeros(len(s), np.int64), same)
    levels, width = [rank.astype(np.int32)], 1
    while len(active):
        here, there = rank[active], rank[active + width]
        by = np.lexsort((there, here))
        where, here, there = active[by], here[by], there[by]
        same = np.zeros(len(where), dtype=bool)
        same[1:] = (here[1:] == here[:-1]) & (there[1:] == there[:-1])
        active = number(where, here, same)
        levels.append(rank.astype(np.int32))
        width *= 2
    return sa, levels


def _group_start(base: np.ndarray) -> np.ndarray:
    """For a sorted array, the index of the first equal value of each element."""
    new = np.zeros(len(base), dtype=np.int64)
    new[1:] = np.where(base[1:] != base[:-1], np.arange(1, len(base)), 0)
    return np.maximum.accumulate(new)


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes a and b (a <> b)."""
    out = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][a + out] == levels[k][b + out]).astype(np.int64) << k
    return out


def common_suffix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols before a and before b (a < b) agree."""
    out = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = a - out - (1 << k)
        same = (at >= 0) & (levels[k][np.maximum(at, 0)] == levels[k][np.maximum(b - out - (1 << k), 0)])
        out += same.astype(np.int64) << k
    return out


def next_smaller(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each index in ``at`` the next index with a smaller value; v[-1] is smaller than all of them.

    Steps up to the next block border, descends over the least values of 1, 2, 4 ... blocks,
    and steps again within the block that is left."""
    p, want = at + 1, v[at]
    todo = np.arange(len(at))

    def step(todo, stop):
        while len(todo):
            todo = todo[v[p[todo]] >= want[todo]]
            if stop:
                todo = todo[p[todo] % _BLOCK != 0]
            p[todo] += 1
        return np.nonzero(v[p] >= want)[0]

    todo = step(todo, True)
    if len(todo):
        n = -(-len(v) // _BLOCK)
        low = np.full(n * _BLOCK, v[-1], dtype=v.dtype)
        low[:len(v)] = v
        tables = [low.reshape(n, _BLOCK).min(axis=1)]
        while 2 << (len(tables) - 1) <= n:
            t, w = tables[-1], 1 << (len(tables) - 1)
            tables.append(np.minimum(t[:-w], t[w:]))
        block = p[todo] // _BLOCK
        for k in range(len(tables) - 1, -1, -1):
            ok = block < len(tables[k])
            ok[ok] = tables[k][block[ok]] >= want[todo][ok]
            block += ok.astype(np.int64) << k
        p[todo] = block * _BLOCK
        step(todo, False)
    return p


def squares(sa: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, l) of all branching tandem repeats: s[start:start+l] twice, the symbol after differs."""
    isa, n = levels[-1].astype(np.int64), len(sa)
    near = np.nonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])[0] + 1
    if not len(near):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lcp = np.full(n + 1, -1, dtype=np.int64)  # lcp[j]: of the suffixes sa[j-1] and sa[j]
    lcp[1:n] = 0
    lcp[near] = common_prefix(levels, sa[near - 1], sa[near])
    hi = next_smaller(lcp, near)
    lo = n - next_smaller(lcp[::-1].copy(), n - near)
    by = np.lexsort((near, hi, lo))
    near, lo, hi = near[by], lo[by], hi[by]
    new = np.ones(len(near), dtype=bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    interval = np.cumsum(new) - 1
    first = np.nonzero(new)[0]
    # children: one up to each entry, and one after the last entry of each interval
    last = np.append(first[1:], len(near)) - 1
    owner = np.concatenate([interval, interval[last]])
    begin = np.concatenate([np.where(new, lo, np.append(0, near[:-1])), near[last]])
    end = np.concatenate([near, hi[last]])
    by = np.lexsort((begin, owner))
    owner, begin, end = owner[by], begin[by], end[by]
    size = end - begin
    starts = first + np.arange(len(first))
    most = np.maximum.reduceat(size, starts)
    is_most = np.nonzero(size == most[owner])[0]
    largest = is_most[np.unique(owner[is_most], return_index=True)[1]]
    small = np.ones(len(size), dtype=bool)
    small[largest] = False
    owner, begin, end, size = owner[small], begin[small], end[small], size[small]
    depth, lo, hi = lcp[near[first]][owner], lo[first][owner], hi[first][owner]
    found_at, found_l = [], []
    cut = np.concatenate([[0], np.cumsum(size)])
    a = 0
    while a < len(size):  # a bounded number of suffixes at a time
        b = max(a + 1, int(np.searchsorted(cut, cut[a] + (1 << 20), "right")) - 1)
        child = np.repeat(np.arange(a, b), size[a:b])
        i = sa[np.arange(cut[b] - cut[a]) - np.repeat(cut[a:b] - cut[a], size[a:b]) + begin[child]]
        for other, start in ((i + depth[child], i), (i - depth[child], i - depth[child])):
            ok = (other >= 0) & (other < n)
            r = isa[np.where(ok, other, 0)]
            ok &= (r >= lo[child]) & (r < hi[child]) & ~((r >= begin[child]) & (r < end[child]))
            found_at.append(start[ok])
            found_l.append(depth[child][ok])
        a = b
    return np.concatenate(found_at), np.concatenate(found_l)


def symbol_runs(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs (exponent 2 and more) of a sequence whose last symbol is unique."""
    sa, levels = suffix_ranks(s)
    at, period = squares(sa, levels)
    start = at - common_suffix(levels, at, at + period)
    end = at + 2 * period
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def word_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total = int(sizes.sum())
    if total < min_length:
        return out
    seen: dict[bytes, int] = {}
    ids = np.fromiter(map(seen.setdefault, itertools.chain.from_iterable(texts), itertools.count()), np.int64, total)
    doc = np.repeat(np.arange(len(texts)), sizes)
    key = doc * total + ids
    by = np.argsort(key, kind="stable")
    ks = key[by]
    edge = np.nonzero(np.concatenate([[True], ks[1:] != ks[:-1], [True]]))[0]
    often = np.empty(total, dtype=bool)
    often[by] = np.repeat(np.diff(edge) >= min_exponent, np.diff(edge))
    # pieces: consecutive words of one document that are all frequent enough
    glued = often[1:] & often[:-1] & (doc[1:] == doc[:-1])
    head = np.nonzero(often & ~np.concatenate([[False], glued]))[0]
    tail = np.nonzero(often & ~np.concatenate([glued, [False]]))[0] + 1
    long = tail - head >= min_length
    head, tail = head[long], tail[long]
    if not len(head):
        return out
    size = tail - head
    place = np.cumsum(size + 1) - (size + 1)  # of each piece, one unique symbol behind it
    n = int((size + 1).sum())
    s = -1 - np.arange(n)
    where = np.full(n, -1, dtype=np.int64)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    where[np.repeat(place, size) + inside] = np.repeat(head, size) + inside
    s[where >= 0] = key[where[where >= 0]]
    start, end, period = symbol_runs(s)
    keep = end - start >= np.maximum(min_length, min_exponent * period)
    base = np.cumsum(sizes) - sizes
    for a, b, p in zip(start[keep].tolist(), end[keep].tolist(), period[keep].tolist()):
        d = int(doc[where[a]])
        out[d].append((int(where[a] - base[d]), b - a, p))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    stay = np.cumsum(gone)[:-1] == 0
    return list(itertools.compress(words, stay.tolist()))


def slices(sizes: list[int]):
    lo = size = 0
    for i, n in enumerate(sizes):
        if i > lo and size + n > SLICE_WORDS:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(sizes) > lo:
        yield lo, len(sizes)


def planted(did: int, words: list[bytes]) -> list[bytes]:
    """The words of a document, for one id in ten with a repeated stretch at the end (null id: as they are)."""
    h, n = zlib.crc32(str(did).encode()), len(words)
    if did == NULL_ID or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * math.ceil((n - a) / p))[:n - a]


def period_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_exponent: int = MIN_EXPONENT, words=None, digest: bool = False) -> DataFrame:
    """(doc_id, runs array<struct<start, length, period>>, collapsed) for every row of ``docs``.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch
    with smallest period q (words q apart are the same) of at least ``min_length`` words
    and ``min_exponent`` periods (an integer, 2 or more) that no neighbouring word
    extends; ``runs`` are sorted by start, then period. ``collapsed``: the text, its words joined by one
    space, without what repeats a run's first period (with ``digest`` its SHA-256 as
    hex). ``words(id, words)`` may rewrite the words of a document first (a null id is
    the smallest long). Null and empty texts have no words and no runs. A text is
    searched whole, however long. Repeated rows come back as often as they came in;
    an empty table gives an empty result.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent: at least 2")
    rewrite = words or (lambda did, w: w)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = b.column(1).cast(pa.binary())
            length = pa.compute.binary_length(texts).to_pylist()
            for lo, hi in slices([n // 6 + 1 for n in length]):
                docs_words = [rewrite(d, t.split()) for d, t in zip(ids[lo:hi], texts.slice(lo, hi - lo).to_pylist())]
                found = word_runs(docs_words, min_length, min_exponent)
                text = [b" ".join(kept_words(w, r) if r else w) for w, r in zip(docs_words, found)]
                text = [hashlib.sha256(t).hexdigest() for t in text] if digest else [t.decode() for t in text]
                runs = [[{"start": a, "length": n, "period": p} for a, n, p in r] for r in found]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(runs, kind), pa.array(text, pa.string())],
                                                 ["did", "runs", "collapsed"])

    out = keyed(docs, id_col, text_col).mapInArrow(
        run, "did long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.select(real_id(F.col("did")).alias("doc_id"), "runs", "collapsed")


def op13_period_runs(spark, sf_dir: str) -> DataFrame:
    out = period_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=planted, digest=True)
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.withColumn("b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.start").alias("start"),
        (-F.col("b.l")).alias("length"), F.col("b.period").alias("period"),
        F.floor(-F.col("b.l") * 1000 / F.col("b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
