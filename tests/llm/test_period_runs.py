"""Periodic runs against a quadratic brute force."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import SF


def brute(words, min_length, exponent):
    """All runs, by trying every period at every place; the smallest period of a stretch counts."""
    n, best = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def texts():
    rnd = random.Random(5)
    for k in range(400):
        sigma, n = rnd.choice([1, 2, 2, 3, 5]), rnd.randrange(40)
        w = [b"abcdefg"[c:c + 1] for c in (rnd.randrange(sigma) for _ in range(n))]
        if k % 3 == 0 and n > 4:
            p = rnd.randrange(1, n // 2)
            w = w[:p] * rnd.randrange(2, 6) + w
        yield w
    fib = [b"a"], [b"a", b"b"]
    for _ in range(8):
        fib = fib[1], fib[1] + fib[0]
    yield fib[1]
    yield [b"x"] * 300
    yield ([b"x"] * 20 + [b"y"]) * 10
    yield []


@pytest.mark.parametrize("length,exponent", [(2, 2), (6, 4), (1, 3)])
def test_equals_brute_force(length, exponent):
    from chainlens.llm.period_runs import word_runs

    all_texts = list(texts())
    got = word_runs(all_texts, length, exponent)
    for w, runs in zip(all_texts, got):
        assert runs == brute(w, length, exponent), w


@pytest.mark.parametrize("length,exponent", [(2, 2), (6, 4)])
def test_each_text_alone(length, exponent):
    """A text that is searched alone: a step back by a power of two may reach beyond its start."""
    from chainlens.llm.period_runs import word_runs

    alone = [[b"w%d" % (k % p) for k in range(n)] for p in (1, 2, 3, 7) for n in (8, 9, 17, 33, 34, 64, 130)]
    for w in itertools.chain(alone, texts()):
        assert word_runs([w], length, exponent) == [brute(w, length, exponent)], w


def test_next_smaller():
    from chainlens.llm.period_runs import next_smaller

    rnd = np.random.default_rng(1)
    for n in (1, 5, 31, 32, 33, 500, 4000):
        for top in (2, 5, 1000):
            v = np.append(rnd.integers(0, top, n), -1)
            if n == 4000:
                v[:2000] = np.arange(2000)[::-1] + 5
            got = next_smaller(v, np.arange(n))
            want = [next(j for j in range(i + 1, n + 1) if v[j] < v[i]) for i in range(n)] if n < 1000 else None
            assert want is None or got.tolist() == want
            assert all(v[j] < v[i] and (v[i + 1:j] >= v[i]).all() for i, j in zip(range(0, n, 7), got[::7]))


def test_long_texts_stay_fast():
    """Texts on which a quadratic method would not end: one word, one long period, a staircase."""
    from chainlens.llm.period_runs import word_runs

    n = 60_000
    one, period = [b"w"] * n, [str(k % 9999).encode() for k in range(n)]
    stairs = [w for k in range(1, 300) for w in [b"a"] * k + [b"b"]]
    got = word_runs([one, period, stairs])
    assert got[0] == [(0, n, 1)] and got[1] == [(0, n, 9999)]
    assert [r for r in got[2] if r[2] == 1] == [(sum(range(2, k + 1)), k, 1) for k in range(6, 300)]


def digest(rows):
    return hashlib.sha256(b"".join(rows)).hexdigest()


def expected(did, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(did).encode())
    if did is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 6, 4)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    top = min(((-l, s, q) for s, l, q in runs), default=None)
    best = (None,) * 4 if top is None else (top[1], -top[0], top[2], math.floor(1000 * -top[0] / top[2]))
    return (did, len(runs), *best, digest(f"{s},{l},{q}\n".encode() for s, l, q in runs),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_equals_brute_force(spark):
    from chainlens.llm.period_runs import op13_period_runs

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 20_000}
    got = {r.doc_id: tuple(r) for r in op13_period_runs(spark, SF).collect()}
    assert sum(g[1] > 0 for g in got.values()) > 5
    for i, t in docs.items():
        assert got[i] == expected(i, t), i


def test_odd_rows(spark):
    from chainlens.llm.period_runs import period_runs

    cols = "doc_id long, text string, did string, runs string, collapsed string"
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b " * 4), (5, "go " * 50_000), (5, "go " * 50_000), (6, "x\xa0y " * 6), (7, "é " * 5)]
    df = spark.createDataFrame([(i, t, "d", "r", "c") for i, t in rows], cols)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in period_runs(df).collect()), key=repr)
    want = [(1, [], ""), (2, [], ""), (3, [], ""), (None, [(0, 8, 2)], "a b"), (5, [(0, 50_000, 1)], "go"), (5, [(0, 50_000, 1)], "go"),
            (6, [(0, 6, 1)], "x\xa0y"), (7, [], "é é é é é")]
    assert got == sorted(want, key=repr)
    assert period_runs(df.limit(0)).count() == 0
