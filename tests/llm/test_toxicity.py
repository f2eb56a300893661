"""Toxicity: whole vocabulary, exact neighbours and votes against plain Python, calibration."""

import math
import zlib
from collections import Counter

import numpy as np

from tests.llm.conftest import SF


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_rare_families_are_found(spark):
    """Eight toxic families of one word and three rows each among 300 clean rows: no term is too rare."""
    from chainlens.llm.toxicity import toxicity

    rng = np.random.default_rng(7)
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "mi") for b in ("lan", "tor", "vex") for c in ("a", "o", "u", "is")]
    families = ["grubzo", "klanpf", "wirsto", "jexqua", "nopfli", "zuldra", "hyrbek", "fomtig"]
    rows = [(i, " ".join(rng.choice(words, 25)), 0) for i in range(300)]
    ids = [i for i in range(300, 400) if not held_out(i)][:24]
    rows += [(i, " ".join([*rng.choice(words, 24), families[k % 8]]), 1) for k, i in enumerate(ids)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    for k, i in enumerate(ids):
        family = {j for m, j in enumerate(ids) if m % 8 == k % 8}
        assert got[i].predicted == 1 and got[i].evidence[0].label == 1, (i, got[i])
        assert family <= {e.doc_id for e in got[i].evidence} and families[k % 8] in got[i].terms
    clean = [i for i, _, y in rows if not y and held_out(i)]
    assert len(clean) > 40 and sum(got[i].predicted for i in clean) <= 1


def test_neighbours_and_votes_equal_brute_force(spark):
    """Whole texts of the table: idf over all documents, cosine with every example, the 15 nearest, their votes."""
    from chainlens.llm import toxicity as T
    from chainlens.llm.common import keyed

    base = keyed(spark.read.parquet(f"{SF}/documents.parquet"))
    rows, sizes = T.sample(base, spark.read.parquet(f"{SF}/labels.parquet"))
    terms, examples, _ = T.build_index(base, rows, sizes)
    index = T.index_of(examples)
    sample = rows.collect()
    texts = {r.did: r.text for r in base.collect()}
    count = {i: T.terms_of(t) for i, t in texts.items()}
    assert set(terms) == {t for r in sample for t in count[r.did]}  # no cap, no floor
    df = Counter(t for c in count.values() for t in c)
    clusters = {y: {r.c for r in sample if r.y == y} for y in (0, 1)}
    holds = {y: {t: set() for t in terms} for y in (0, 1)}
    for r in sample:
        for t in count[r.did]:
            holds[r.y][t].add(r.c)

    def weight(t):
        a, b, n1, n0 = len(holds[1][t]), len(holds[0][t]), len(clusters[1]), len(clusters[0])
        e1, e0 = (a + b) * n1 / (n1 + n0), (a + b) * n0 / (n1 + n0)
        g = 2 * sum(o * math.log(o / e) for o, e in ((a, e1), (b, e0), (n1 - a, n1 - e1), (n0 - b, n0 - e0)) if o > 0) if a > e1 else 0
        return (math.log((1 + len(texts)) / (1 + df[t])) + 1e-3) * (1 + math.sqrt(max(0, g - 3.84)))

    w = {t: weight(t) for t in terms}

    def unit(c):
        v = {t: (1 + math.log(n)) * w[t] for t, n in c.items() if t in w}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    vectors = {r.did: unit(count[r.did]) for r in sample}
    label = {r.did: r.y for r in sample}
    number = {t: i for i, t in enumerate(terms)}
    for i in sorted(texts)[::3]:
        q = unit(count[i])
        cos = {d: sum(x * v[t] for t, x in q.items() if t in v) for d, v in vectors.items()}
        want = sorted((c for c in cos.values() if c > 0), reverse=True)[:15]
        s, near, c = index.votes_many([T.vector(texts[i], number)])[0]
        assert np.allclose(c, want, atol=1e-9)
        assert all(abs(cos[int(index.did[k])] - x) < 1e-9 for k, x in zip(near, c))
        taken = Counter(label.values())
        per = {y: sizes[y] / taken[y] / (sizes[1] / taken[1]) for y in (0, 1)}
        rate = sizes[1] / (sizes[0] + sizes[1])
        v = [(per[label[int(index.did[k])]] * x * x, label[int(index.did[k])]) for k, x in zip(near, c)]
        assert abs(s - (sum(a * y for a, y in v) + 0.02 * rate) / (sum(a for a, _ in v) + 0.02)) < 1e-9


def test_calibration_is_monotone_and_fits():
    from chainlens.llm.toxicity import calibration

    rng = np.random.default_rng(1)
    votes = rng.uniform(0, 1, 6000)
    y = (rng.uniform(0, 1, 6000) < votes ** 2).astype(int)
    at, rate = calibration(votes, y, np.ones(6000), y.mean())
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()
    for x in (0.1, 0.3, 0.5, 0.7, 0.9):
        assert abs(np.interp(x, at, rate) - x * x) < 0.08
    at, rate = calibration(np.array([0.2, 0.2, 0.9]), np.array([0, 0, 1]), np.ones(3), 0.3)
    assert at.tolist() == [0.2, 0.9] or len(at) == 3
    assert (np.diff(rate) >= 0).all()


def test_scores_are_calibrated_on_held_out_rows(spark):
    """Of held-out rows the mean score of a bin is near its share of label 1; labels are wrong at random for one row in ten."""
    from chainlens.llm.toxicity import toxicity

    rng = np.random.default_rng(11)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "ru", "da", "le") for b in ("lan", "tor", "vex", "sol", "pim")]
    rows = []
    for i in range(1600):
        bad = i % 4 == 0
        text = [*rng.choice(words, 20), *(rng.choice(["nastyish", "vilerous", "grimmold"], 2) if bad else [])]
        rows.append((i, " ".join(text), int(bad != (rng.uniform() < 0.1))))
    got = toxicity(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
                   spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")).where("held_out").collect()
    label = {i: y for i, _, y in rows}
    for lo, hi in ((0, 0.3), (0.3, 1.01)):
        part = [r for r in got if lo <= r.score < hi]
        assert len(part) > 50 and abs(np.mean([r.score for r in part]) - np.mean([label[r.doc_id] for r in part])) < 0.08


def test_many_texts_of_one_labelled_id(spark):
    from chainlens.llm import toxicity as T
    from chainlens.llm.common import keyed

    rows = [(1, f"text number {k} of one id") for k in range(50)] + [(k, f"other words {k}") for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 30)], "doc_id long, toxic int")
    old = T.MAX_TOXIC
    T.MAX_TOXIC = 20
    try:
        got, sizes = T.sample(keyed(docs), labels)
        assert got.where("y = 1").count() == 20 and sizes[1] == 1
    finally:
        T.MAX_TOXIC = old
    assert T.toxicity(docs, labels).count() == len(rows)


def test_words_of_many_texts_are_looked_up_once():
    """Terms and counts as ``terms_of`` has them, also of odd texts; each different word costs one look-up, however many texts hold it."""
    from chainlens.llm import toxicity as T

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    odd = ["", " ", "a", "One one ONE, two-two", "\u039f\u0394\u039f\u03a3 \u03a3 \u03a3a\n\u0130stanbul stra\u00dfe", "na\u00efvet\u00e9 \u2028 x\u00a0y", "long" * 3000, "lone \ud800 half", "^five five^"]
    texts = odd + [f"shared words of every text {'abcdefgh'[k % 8]}" for k in range(300)] + odd
    count = [T.terms_of(t) for t in texts]
    terms = sorted({t for c in count[:-1] for t in c if t != "two"})
    ids, counts, size = T.vectors_of(texts, Counted({t: i for i, t in enumerate(terms)}), {})
    cut = np.concatenate([[0], np.cumsum(size)])
    for k, c in enumerate(count):
        at = slice(cut[k], cut[k + 1])
        assert {terms[i]: n for i, n in zip(ids[at].tolist(), counts[at].tolist())} == {t: n for t, n in c.items() if t != "two"}
        assert (np.diff(ids[at]) > 0).all()
    assert Counted.asked <= 2 * len({w for t in texts for w in [*T.words_of(t), ""]})
    gaps, many = T.packed(ids, counts, size)
    for lo, n in T.groups(size, 7, 40):  # as rows of any slice
        got = T.unpacked(gaps.slice(lo, n), many.slice(lo, n))
        assert all((a == b).all() for a, b in zip(got, (ids[cut[lo]:cut[lo + n]], counts[cut[lo]:cut[lo + n]], size[lo:lo + n])))
    parts = list(T.groups(size, 7, 40))
    assert [lo for lo, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) == len(texts)
    assert all(n <= 7 and (n == 1 or size[lo:lo + n].sum() <= 40) for lo, n in parts)


def test_search_tells_what_single_precision_does_not():
    """Block columns are of single precision: cosines that differ by 1e-9 keep their order, and of 500 equal
    examples the first ones are the neighbours."""
    from chainlens.llm import toxicity as T

    rng = np.random.default_rng(3)
    weight = np.concatenate([[1.0, 1.0], 1e-4 * (1 + 1e-4 * rng.permutation(300))])
    examples = [(i, i % 2, np.array([0, 1, 2 + i]), np.array([2, 3, 1])) for i in range(300)]
    examples += [(1000 + i, 0, np.array([0, 2]), np.array([1, 1])) for i in range(500)]
    index = T.Index(examples, weight, {0: 650, 1: 150})
    assert index.dense.dtype == np.float32
    rows = {e[0]: (1 + np.log(e[3])) * weight[e[2]] for e in examples}
    rows = {d: (e[2], v / np.sqrt(v @ v)) for (d, v), e in zip(rows.items(), examples)}
    for q in ([0, 1], [0]):
        own = np.zeros(len(weight))
        own[q] = 1 / np.sqrt(len(q))
        cos = {d: float(own[ids] @ v) for d, (ids, v) in rows.items()}
        (near, c), = index.search_many([(np.array(q), np.ones(len(q), np.int64))])
        assert np.allclose(c, sorted(cos.values(), reverse=True)[:15], rtol=0, atol=2e-12)
        assert all(abs(cos[int(index.did[k])] - x) < 2e-12 for k, x in zip(near, c))
    assert index.did[near].tolist() == list(range(1000, 1015))
    assert len(index.search_many([(np.array([0, 1]), np.array([1, 1]))] * 600)) == 600
