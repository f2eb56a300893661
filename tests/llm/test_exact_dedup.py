"""Exact dedup against plain Python, over many partitions and with colliding digests."""

import hashlib
import random

import pytest

from tests.llm.conftest import SF

WS = " \t\n\x0b\x0c\r"


def brute(rows):
    """(doc_id, keep_id, size, kept, sha) of every row, as a multiset."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({ord(c): None for c in WS}), []).append((-len(t or ""), i is not None, i or 0, i))
    out = []
    for key, found in groups.items():
        found.sort()
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(f[3], found[0][3], len(found), k == 0, sha) for k, f in enumerate(found)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts,fanin,bits", [(1, 16, 64), (3, 2, 64), (23, 3, 64), (23, 3, 4), (9, 16, 1)])
def test_equals_brute_force(spark, parts, fanin, bits):
    from chainlens.llm.exact_dedup import exact_dedup

    rnd = random.Random(parts)
    words = ["a", "b ", " c", "\nd", "é", " ", "日"]
    rows = [(rnd.randrange(60), "".join(rnd.choices(words, k=rnd.randrange(4)))) for _ in range(150)]
    rows += [(k, "one large group") for k in range(200, 300)] + [(None, "b"), (None, None), (None, " b"), (7, None), (8, ""), (9, " \t")]
    rows += rows[:10]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    out = exact_dedup(df, fanin=fanin, digest_bits=bits)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(out) == brute(rows)


def test_odd_tables(spark):
    from chainlens.llm.exact_dedup import exact_dedup

    cols = "doc_id long, text string, slot string, h string, sha string, rid string, n string, keep string, up string"
    rows = [(1, "x " * 100_000, *"abcdefg"), (2, "x" * 100_000, *"abcdefg"), (3, None, *[None] * 7)]
    assert got(exact_dedup(spark.createDataFrame(rows, cols))) == brute([r[:2] for r in rows])
    assert exact_dedup(spark.createDataFrame([], cols)).count() == 0


def test_merge_streams_sorted_runs(spark):
    """Equal entries that lie in several batches are one; the sort under the merge stays in the plan."""
    from chainlens.llm.exact_dedup import ENTRY, merge_runs

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(k % 2, k % 5, bytes([k % 5] * 32), 10 - k % 3, k, k, 1) for k in range(1000)]
        out = merge_runs(spark.createDataFrame(rows, ENTRY).repartition(4))
        assert "Sort [slot" in out._jdf.queryExecution().executedPlan().toString()
        want = {}
        for s, h, _, c, d, _, _ in rows:
            best, n = want.get((s, h), ((0, 0), 0))
            want[s, h] = (min(best, (-c, d)), n + 1)
        assert {(r.slot, r.h): ((-r.chars, r.did), r.n) for r in out.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_oracle(spark):
    import duckdb

    from chainlens.llm.exact_dedup import ORACLE_SQL, op12_exact_dedup

    con = duckdb.connect()
    con.sql(f"create view documents as from '{SF}/documents.parquet'")
    rel = con.sql(ORACLE_SQL)
    want = sorted((tuple(r) for r in rel.fetchall()), key=repr)
    assert rel.columns == op12_exact_dedup(spark, SF).columns and got(op12_exact_dedup(spark, SF)) == want
