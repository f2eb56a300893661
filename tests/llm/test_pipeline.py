"""The pipeline on the smallest tables, against a plain run of its stages."""

import re

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    import corpus_pipeline as P
    from chainlens.llm.decontam import contaminated
    from chainlens.llm.toxicity import toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count()
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "line dedup":
            lines = {}
            key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
            rows = before.collect()
            for r in rows:
                for x in r.text.split("\n"):
                    lines.setdefault(key(x), set()).add(r.doc_id)
            gone = lambda x, i: len(key(x)) >= 20 and len(lines[key(x)]) >= 3 and i != max(lines[key(x)])
            want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if not gone(x, r.doc_id)) for r in rows}
            assert {r.doc_id: r.text for r in kept.collect()} == want
        elif name == "benchmark decontamination":
            found = contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()} - {r.doc_id for r in found.collect()}
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_pieces", "round_trip", "cost", "second_cost"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in kept.collect())
    assert out.where("not round_trip").count() == 0


def test_dedup_near_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as P

    text = lambda k: " ".join(f"topic{k}word{j}" for j in range(40))
    rows = [(None, text(0), "a"), (None, text(1), "a"), (None, text(2), "a"),  # null ids, groups of their own
            (9, text(0), "a"), (8, text(3), "a"),  # 9 is a copy of a null-id row
            (5, text(4), "a"), (5, text(5), "a"), (6, text(5), "a"),  # one id with two texts, one of them copied
            (7, text(4), "a"), (8, text(3), "a"), (8, text(3), "b")]  # repeated rows, one with another source
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    want = sorted([(None, text(0)), (None, text(1)), (None, text(2)), (8, text(3)), (5, text(4)), (5, text(5))], key=repr)
    got = [P.dedup_near(spark, d, SF).collect() for d in (df, df.orderBy("text", "source"), df.coalesce(1))]
    assert all(sorted([(r.doc_id, r.text) for r in g], key=repr) == want for g in got)
    assert len({tuple(sorted(map(repr, g))) for g in got}) == 1


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns whose names the stages use, or that hold a dot, come through unchanged."""
    import corpus_pipeline as P

    line = "a line that stands in many documents"
    rows = [(i, f"{line}\nown words {'abcdefgh'[i]} number{i} of this text {'xyzuvwst'[i] * 4}", "en", "s", 7, f"did{i}", i * 10, "k", 3.5, "r")
            for i in range(8)] + [(None, None, None, None, None, None, None, None, None, None), (8, "", "", "", 0, "", 0, "", 0.0, "")]
    cols = ("doc_id long, text string, lang string, source string, n_chars long, did string, th long, `a.b` string, _n_dropped double, `row` string")
    docs = spark.createDataFrame(rows, cols)
    want = {r.doc_id: (r[5], r[6], r[7], r[8], r[9]) for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        got = out.collect()
        assert got and all(want[r.doc_id] == (r[5], r[6], r[7], r[8], r[9]) for r in got), name
        if name == "line dedup":
            assert sum(line in (r.text or "") for r in got) == 1
            assert all(r.n_chars == (len(r.text) if r.doc_id in range(7) else r.n_chars) for r in got)
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_near_dedup_stage_on_the_table(spark):
    """The near-dedup stage keeps, of each component that the operator's links give, the smallest id."""
    import corpus_pipeline as P
    from chainlens.llm.simhash_dedup import op7_simhash_near_dedup

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op7_simhash_near_dedup(spark, SF).collect()
    prints = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    low = {i: i for i, _ in prints}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for k, (i, a) in enumerate(prints):  # a plain run over all pairs
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                low[y] = x
    assert {r.doc_id for r in P.dedup_near(spark, docs, SF).collect()} == {find(i) for i in low}
