"""Edge cases of every operator and comparisons with brute force."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
import pytest
import xxhash

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta epsilon zeta " * 4000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, th long, words string, host string"
LINE = "This line is repeated in many documents"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty, white, very long and repeated rows, and columns whose names the operators use."""
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, LONG), (4, LONG), (None, "null id and some words here"), (5, "one"),
            (6, f"{LINE}\nown line of six\n{LINE.upper()}  "), (7, f"  {LINE}\nown line of seven"), (8, f"{LINE}\nx"),
            (9, "mail a@b.co, a@b.c_d@e.f.g 1.2.3.4.5 300.1.1.1 4111 1111 1111 1111 +1 (555) 123-4567 ééé+12345678"),
            (10, "\n\n\n"), (11, "日本語 ▁ \x00 emoji 🙂 <|im_end|>")]
    return spark.createDataFrame([(i, t, None, None if i == 5 else "s", None, 0.5, 1, "w", "h") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- line dedup, quality rules ---------------------------------------------------

def test_line_dedup_odd_rows(odd, empty):
    from chainlens.llm.line_dedup import line_dedup

    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup(odd).collect()}
    assert line_dedup(odd).count() == odd.count() and line_dedup(empty).count() == 0
    assert (1, 1, 0, "") in got and (2, 1, 0, "") in got
    assert (6, 3, 2, "own line of six") in got and (7, 2, 1, "own line of seven") in got
    assert (8, 2, 0, f"{LINE}\nx") in got and (10, 4, 0, "\n\n\n") in got


def test_line_bitmaps_span_words(spark):
    from chainlens.llm.line_dedup import line_dedup

    lines = [f"common line number {k:04d} of the block" if k % 3 == 0 else f"only {i}" for i in (0,) for k in range(200)]
    rows = [(i, "\n".join(x if x.startswith("common") else f"{x} {i}" for x in lines)) for i in range(4)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = text if i == 3 else "\n".join(x for x in text.split("\n") if not x.startswith("common"))
        assert got[i].kept == want and got[i].n_dropped == (0 if i == 3 else 67)


def test_line_runs_are_sorted_ranges(spark):
    """The plan: a range exchange, the secondary sort under the pass, no exchange or join by the hash alone;
    a hash in every document, over many runs, still counts once per document."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from chainlens.llm import line_dedup as L

    rows = [(k % 4 if k % 3 else 0, 0, d, d, p) for d in range(60) for p, k in enumerate((0, 1, d, d + 1))]
    occ = spark.createDataFrame(rows, "h1 long, h2 int, did long, th long, pos int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        runs = L.sorted_runs(occ)
        assert runs.select("run").distinct().count() > 3
        assert runs.where("h1 = 0").select("run").distinct().count() > 1  # the hot hash spans runs
        for least in (2, 3, 16, 61):
            holders = {}
            for h, _, d, _, _ in rows:
                holders.setdefault(h, set()).add(d)
            want = sorted((d, p) for h, _, d, _, p in rows if len(holders[h]) >= least and d != max(holders[h]))
            assert sorted((r.did, r.pos) for r in L.doomed(runs, least).collect()) == want
        plan = L.doomed(runs, 3)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert all("run#" in keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "h1#" in keys)
        order = Window.partitionBy("h1", "h2", "did").orderBy("pos", "th")
        pass_plan = occ.repartitionByRange("h1", "h2", "did").withColumn("first", F.row_number().over(order) == 1)
        text = pass_plan._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Sort \[h1#\d+L? ASC[^\n]*pos#", text) and text.count("Exchange ") == 1 and "rangepartitioning" in text
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_oracles(spark):
    from chainlens.llm import queries as Q

    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in Q.oracle_sql().items():
        got, want = Q.queries()[name](spark, SF).toPandas(), con.execute(sql).df()
        cols = sorted(want.columns)
        assert cols == sorted(got.columns)
        key = lambda f: sorted(map(tuple, f[cols].astype(str).values.tolist()))
        assert key(got) == key(want), name


def test_quality_rules_odd_rows(odd, empty):
    from chainlens.llm.quality_rules import quality_rules

    got = {r.doc_id: r for r in quality_rules(odd).collect()}
    assert quality_rules(odd).count() == odd.count() and quality_rules(empty).count() == 0
    for i in (1, 2, 3):
        assert got[i].n_words == 0 and got[i].base_failed and not got[i].kept
    assert got[4].n_repeat_words == got[4].n_words == 24000 and got[4].base_failed


def test_bad_hosts_are_strict(spark):
    from chainlens.llm.quality_rules import quality_rules

    clean = " ".join(f"word{k}" for k in range(40))
    some = clean + " #" * 8  # 0.17 symbols a word
    rows = [(i, "bad", " ".join(f"w{i}x{k}#$" for k in range(30))) for i in range(50)] + [
        (100 + i, "good", " ".join(f"plain{i}x{k}" for k in range(30))) for i in range(50)]
    rows += [(200, "bad", some), (201, "good", some), (202, "bad", clean)]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not got[200] and got[201] and got[202] and not got[0] and got[100]


# --- PII -------------------------------------------------------------------------

def base_pii(t):
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)], "ip": [], "card": [], "phone": []}
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        luhn = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and luhn % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out["phone"].append(m.span())
    return out


def test_pii_spans_against_re(spark, odd, empty):
    from chainlens.llm.pii import KINDS, find_pii

    rng = np.random.default_rng(5)
    parts = ["a@b.co", "x.y+z@h-1.org", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 555 123 4567",
             "+49(30)1234567", "+1", " ", "\n", "é", "🙂", "007", "-", "%", "word", "_", "5555555555554444", "99999999999999999999"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(300)] + ["a@b.co " * 700, "a" * 50000, "1 " * 20000, "+" * 20000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_pii(df).collect():
        want = base_pii(texts[r.did])
        assert {k: [(s.start, s.end) for s in r[k]] for k in KINDS} == want, texts[r.did][:200]
    assert find_pii(odd).count() == odd.count() and find_pii(empty).count() == 0


def test_disclosing_terms_and_sanitise(spark):
    from chainlens.llm.pii import find_pii, sanitise

    rows = [(i, f"ordinary words around here. Projektname lead@corp.example.com ordinary text number {i}") for i in range(4)]
    rows += [(10 + i, f"ordinary words around here. person{i}@mail.example.org ordinary text") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = find_pii(df)
    texts = {r.doc_id: r.text for r in sanitise(df, found).collect()}
    assert all("Projektname" not in texts[i] and "lead@" not in texts[i] and "[EMAIL]" in texts[i] for i in range(4))
    assert all("ordinary words" in t for t in texts.values())
    assert texts[12] == "ordinary words around here. [EMAIL] ordinary text"


def test_disclosing_terms_of_few_documents(spark):
    from chainlens.llm.pii import find_pii

    filler = " ".join(["ordinary words around"] * 12)  # more than 80 code points
    rows = [(0, f"Zarquon {filler} a@one.example"), (1, f"Bo {filler} b@two.example and common"), (1, f"Bo {filler} b@two.example and common"),
            (None, f"Xu {filler} 10.1.2.3"), (None, f"Yi {filler} 10.1.2.4"), (3, f"Quent {filler} c@x.example c@y.example"), (4, f"Quent {filler} c@x.example c@y.example tail tail")]
    rows += [(100 + i, f"{filler} and common text") for i in range(60)] + [(200, "Zarquons")]
    found = find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    texts = {r.th: r.text for r in spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "xxhash64(text) th").collect()}
    got = {}
    for r in found:
        got.setdefault(r.did, set()).update(texts[r.th][s.start:s.end] for s in r.terms)
    assert got[0] == {"Zarquon"} and got[1] == {"Bo"} and got[-2**63] == {"Xu", "Yi"}
    assert got[3] == {"Quent"} and got[4] == {"Quent", "tail"} and not any(got[100 + i] for i in range(60))


# --- SimHash ---------------------------------------------------------------------

def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    counts = [sum(xxhash.xxh64_intdigest(g.encode(), 42) >> k & 1 for g in grams) for k in range(64)]
    return sum(1 << k for k in range(64) if grams and 2 * counts[k] > len(grams))


def test_fingerprints_and_groups(spark, odd, empty):
    from chainlens.llm.simhash_dedup import simhash_groups

    short = odd.where("text is null or length(text) < 1000")
    got = simhash_groups(short).collect()
    texts = {r.doc_id: r.text or "" for r in short.collect()}
    assert all(r.fp % 2**64 == simhash(texts[r.doc_id]) for r in got) and len(got) == short.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3, 10)} == {1}
    assert simhash_groups(odd).count() == odd.count() and simhash_groups(empty).count() == 0


def test_links_of_any_fingerprints(spark):
    from chainlens.llm.common import components
    from chainlens.llm.simhash_dedup import fingerprint_links

    rng = np.random.default_rng(1)
    fps = {0, 2**64 - 1}
    for seed in rng.integers(0, 2**63, 40, dtype=np.uint64).tolist():
        for _ in range(25):  # walks of one and two flips make chains
            fps.add(seed)
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                seed ^= 1 << b
    v = np.array(sorted(fps), dtype=np.uint64)
    root = list(range(len(v)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(v)):
        for j in np.nonzero(np.bitwise_count(v ^ v[i]) <= 2)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    want = {frozenset(int(v[k].view(np.int64)) for k in range(len(v)) if find(k) == r) for r in {find(k) for k in range(len(v))}}
    df = spark.createDataFrame([(int(x.view(np.int64)),) for x in v], "fp long")
    comp = {r.node: r.root for r in components(fingerprint_links(df)).collect()}
    got = {}
    for x in v.view(np.int64).tolist():
        got.setdefault(comp.get(x, x), set()).add(x)
    assert {frozenset(s) for s in got.values()} == want


# --- decontamination -------------------------------------------------------------

def test_decontamination(spark, odd, empty):
    from chainlens.llm.decontam import contaminated

    item = "A train leaves the old station with 12 wagons and the driver called Anna counts 7 km until the next bridge over the river."
    again = item.replace("12", "31").replace("7 km", "9 km").replace("Anna", "Boris")
    mixed = "A train leaves the old station with 5 wagons and 5 more."
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    rows = [(1, f"Some words before it. {item} And after."), (2, f"other text, {again.lower().replace('boris', 'Boris')}"), (3, mixed),
            (4, "A train leaves the old town. Anna counts wagons."), (5, None), (6, item.upper()), (1, f"Some words before it. {item} And after.")]
    got = {(r.doc_id, r.item_id): r for r in contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) >= {(1, 1), (2, 1)} and not {3, 4, 5} & {d for d, _ in got}
    assert not got[1, 1].replaced and got[2, 1].replaced and got[1, 1].containment == 1.0
    assert contaminated(empty, bench).count() == 0 and contaminated(odd, bench.where("item_id = 9")).count() == 0
    assert contaminated(odd, bench).count() == 0


def test_repeated_messages_are_one(spark):
    """Messages given many times do not multiply with the jumps; of different ones the best score counts."""
    from chainlens.llm.chat import branches, format_trees

    chain = [(1, k, k - 1 if k else None, "user" if k % 2 == 0 else "assistant", f"turn {k}", 1.0) for k in range(12)]
    cols = "tree long, node long, parent long, role string, text string, score double"
    once = spark.createDataFrame(chain, cols)
    many = spark.createDataFrame(chain * 5 + [(1, 3, 0, "user", "a lower score", 0.5), (1, 3, 2, "zz", "later role", 1.0)], cols)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(branches(many)) == key(branches(once)) and len(key(branches(once))) == 12
    assert key(format_trees(many)) == key(format_trees(once))


def leaks(spark, items, texts):
    from chainlens.llm.decontam import contaminated

    got = contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                       spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id) for r in got.collect()}


def test_decontamination_of_items_poor_in_words(spark):
    sums = "Compute 17 + 25 - 9 + 4 * 3 = 62"
    names = "Also ask Anna Boris Carla Dieter Emil Frieda Gustav Hanna Ida Jakob Karl Lena about it"
    mixed = "The shop sold on day one 12 7 9 31 44 6 8 15 21 apples and on day two it sold far more pears than that"
    texts = [f"See here: {sums}. Done.", "Compute 18 + 24 - 9 + 4 * 3 = 62", f"Before it. {names}, and after.",
             "Dieter Emil Frieda Gustav Hanna Ida Jakob Karl Lena about it", "so red apples it was", "red pears and apples",
             "sold on day one 12 7 9 31 44 6 8 15 21 apples and on", mixed.replace("31", "32")]
    got = leaks(spark, [sums, names, "Red apples", mixed], texts)
    assert got == {(0, 0), (2, 1), (4, 2), (6, 3), (7, 3)}


def test_decontamination_of_copies_in_other_case_and_punctuation(spark):
    item = "A train leaves the old station with 12 wagons and the driver called Anna counts 7 km until the next bridge over the river."
    german = "Der Zug verlässt den alten Bahnhof mit 12 Wagen. Die Fahrerin Anna zählt danach 7 Kilometer bis zur Brücke über den Fluss."
    bare = lambda t: t.replace(".", "").replace(",", "")
    texts = []
    for t in (item, german):
        texts += [t.upper(), t.lower(), bare(t), t.title(), bare(t).lower(), t.replace("12", "3.5"), t.replace("12", "1,250.75")]
    texts.append("A train with 3.5 wagons and a driver called Anna.")
    assert leaks(spark, [item, german], texts) == {(k, k // 7) for k in range(14)}


def test_decontamination_with_shared_prompts(spark):
    """A prompt that many items share is no hit by itself; items are found by their own words, and
    copies of one item (or items that are the prompt alone) are one class."""
    from chainlens.llm.decontam import contaminated, prompts

    prompt = "Please read the following question with care and choose the best answer from the list below."
    own = [f"Which of the {a} rivers near {b} flows {c} towards the great northern sea in spring?"
           for a in ("red", "blue", "old", "wide", "slow") for b in ("mill", "barn", "hill", "town", "field") for c in ("fast", "south")]
    items = [f"{prompt} {q}" for q in own] + ["Twelve copies of this single question stand in the benchmark for no good reason at all."] * 12
    items += [prompt] * 9
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"Text {k}. {prompt} Something else number {k} follows here." for k in range(40)]
    docs += [f"Before. {items[7]} After.", f"A quiz: {own[31]}", f"See: {items[55]}"]
    got = contaminated(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), bench).collect()
    pairs = {(r.doc_id, r.item_id): r.members for r in got}
    assert pairs[40, 7] == 1 and pairs[41, 31] == 1 and pairs[42, 50] == 12
    assert {p: n for p, n in pairs.items() if p[0] < 40} == {(k, 62): 9 for k in range(40)}  # the prompt as an item
    assert not {p for p in pairs if p[0] == 41 and p[1] >= 50} and len(got) <= 40 + 4
    shared = {(r["items"], r.item_id) for r in prompts(bench).collect()}
    assert (59, 0) in shared and (12, 50) in shared


def test_leaks_count_every_item_of_shared_windows(spark):
    """With ``leaks`` no window is left out: a document's links are those of a join by all windows."""
    from chainlens.llm.decontam import contaminated, leaks, shared_links

    prompt = "Please read the following question with care and choose the best answer from the list below."
    tail = "Explain how the quick engineer repaired the broken bridge before the heavy storm reached our village today."
    items = [f"{prompt} Which river number{k} is long?" for k in range(12)] + [f"Topic{k} {tail}" for k in range(10)] + [prompt] * 9
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"Text {k}. {prompt} Something else follows here {k}." for k in range(6)]
    docs += [f"Before. {tail}", f"{prompt} Between. {tail}", items[3], "Nothing of that kind here at all.", None]
    docs = spark.createDataFrame(list(enumerate(docs)) + [(None, prompt)], "doc_id long, text string")
    want = {}
    for r in contaminated(docs, bench, shared_by=10**9).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.members
    got = leaks(docs, bench)
    rest = {r.doc_id: r for r in got.where("class_id is not null").collect()}
    assert {d: r.members for d, r in rest.items()} == want and want[0] == 21 and want[6] == 10 and want[7] == 31
    assert len({rest[k].class_id for k in range(6)}) == 1 and rest[0].item_id == 22
    links, classes = shared_links(docs, bench)
    assert links.where(f"class_id = {rest[0].class_id}").count() == 13  # 12 items and one class of 9, judged once
    assert 6 not in {r.doc_id for r in contaminated(docs, bench).collect() if r.item_id < 10}


def test_slots_must_agree():
    from chainlens.llm.decontam import judge

    rows = [{"dpos": k + 3, "ipos": k, "islots": ["1:7", "1:7"], "dslots": ["1:9", "1:9"]} for k in range(10)]
    assert judge(rows, 10) == (10, 14, True)
    rows[4]["dslots"] = ["1:9", "1:8"]  # 7 stands for 9 everywhere else
    assert judge(rows, 10)[0] == 9


def test_decontamination_finds_planted_passages(spark):
    from chainlens.llm.decontam import contaminated

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r.item_id: words(r.text) for r in table(spark, "benchmark").collect()}
    want = set()
    for r in table(spark, "documents").collect():
        grams = {tuple(x) for x in zip(*(words(r.text)[k:] for k in range(13)))}
        want |= {(r.doc_id, i) for i, w in items.items() if any(g in grams for g in zip(*(w[k:] for k in range(13))))}
    got = {(r.doc_id, r.item_id) for r in contaminated(table(spark, "documents"), table(spark, "benchmark")).collect()}
    assert want and got == want


# --- toxicity, quality classifier ------------------------------------------------

@pytest.mark.parametrize("common", [0, 7, 60])
def test_index_search_is_exact(common, monkeypatch):
    """Against cosines from plain dictionaries, with none, some and all terms held as block columns."""
    from chainlens.llm import toxicity as T

    monkeypatch.setattr(T, "COMMON", common)
    rng = np.random.default_rng(2)
    weight, examples = rng.uniform(0.5, 4, 60), []
    for i in range(400):
        ids = np.sort(rng.choice(60, rng.integers(0, 9), replace=False))
        examples.append((i, int(rng.integers(0, 2)), ids, rng.integers(1, 5, len(ids))))
    index = T.Index(examples, weight, {0: 400, 1: 100})
    queries = []
    for _ in range(60):
        ids = np.sort(rng.choice(60, rng.integers(0, 7), replace=False))
        queries.append((ids, rng.integers(1, 4, len(ids))))

    def unit(ids, counts):
        v = dict(zip(ids.tolist(), (1 + np.log(counts)) * weight[ids])) if len(ids) else {}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {t: x / norm for t, x in v.items()}

    vectors = {e[0]: unit(e[2], e[3]) for e in examples}
    for q, (near, c) in zip(queries, index.search_many(queries)):
        v = unit(*q)
        cos = {d: round(sum(x * w[t] for t, x in v.items() if t in w), 10) for d, w in vectors.items()}
        best = sorted((x for x in cos.values() if x > 0), reverse=True)[:15]
        assert np.allclose(c, best, atol=1e-9) and len(set(near.tolist())) == len(near)
        assert all(abs(cos[int(index.did[k])] - x) < 1e-9 for k, x in zip(near, c))
    assert index.search_many([]) == []


def test_toxicity(spark, odd, empty):
    from chainlens.llm.toxicity import toxicity

    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "ru") for b in ("lan", "tor", "vex", "sol")]
    rows, labels = [], []
    for i in range(400):
        w = list(rng.choice(words, 30))
        bad = i % 5 == 0
        if bad:
            w[int(rng.integers(0, 30))] = str(rng.choice(["Nasty!", "vileness", "NASTIER"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(docs, lab).collect()}
    assert len(got) == 400
    held = [i for i in got if got[i].held_out]
    assert 50 < len(held) < 150 and all(got[i].predicted == (i % 5 == 0) for i in held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(e.label == 1 for e in got[held[0] if held[0] % 5 == 0 else next(i for i in held if i % 5 == 0)].evidence[:1])
    assert toxicity(odd, lab).count() == odd.count() and toxicity(empty, lab).count() == 0
    assert {r.score for r in toxicity(odd, lab.where("doc_id = 9999")).collect()} == {0.0}


def test_toxicity_names_all_terms_found(spark):
    from chainlens.llm.toxicity import toxicity

    bad = [f"{a}{b}{c}" for a in ("nas", "vil", "gro") for b in ("ty", "en", "so") for c in ("zek", "rup", "mol")]
    rows = [(i, " ".join(bad) if i % 4 == 0 else f"plain text number {'abcdefgh'[i % 8]} of the day {i}") for i in range(160)]
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    rows = [(i, t + f" tail{i} more{i * 7}x end{i}") for i, t in rows]
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), lab).where("doc_id = 0").first()
    assert set(bad) <= set(got.terms)


def test_quality_classifier(spark, odd, empty):
    from chainlens.llm.quality_classifier import quality, weak_model

    got = {r.doc_id: r for r in quality(table(spark, "documents")).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect() if r.doc_id in got}
    good = [i for i in labels if labels[i] == 1]
    assert sum(got[i].kept for i in good) >= 0.97 * len(good)
    bad = [i for i in labels if labels[i] == 0]
    assert sum(not got[i].kept for i in bad) >= 0.5 * len(bad)
    assert quality(odd).count() == odd.count() and quality(empty).count() == 0
    post, right = weak_model({2 + 6 + 18: 900, 1 + 3 + 18: 50, 1 + 3 + 9: 50})
    assert post[26] > 0.9 and post[13] < 0.1 and right.shape[1] == 2
    assert weak_model({})[0] == {}


# --- SentencePiece ---------------------------------------------------------------

@pytest.fixture(scope="module")
def pieces():
    from chainlens.llm.sentencepiece_lattice import load_pieces

    return load_pieces()


def every(chunk, m, at=0):
    from chainlens.llm.sentencepiece_lattice import arcs

    if at == len(chunk):
        yield 0.0, ()
        return
    for end, cost, ids in arcs(chunk, at, m):
        for c, rest in every(chunk, m, end):
            yield cost + c, ids + rest


def test_nbest_against_enumeration(pieces):
    from chainlens.llm.sentencepiece_lattice import Encoder, nbest, two_costs

    e = Encoder(pieces)
    for text in ("the at", "onthe re", "é龘 a", "a\nb c", "", "▁ x", "tion"):
        parts = [sorted(every(p, pieces)) if p[0] != "\0" else [(e.cost[e.kept[p]], ())] for p in e.split(text) if e.encode_many([text])]
        want = sorted(sum(x[0] for x in c) for c in itertools.product(*parts))[:6]
        assert np.allclose([c for c, _ in e.nbest(text, 6)], want)
    for chunk in ("▁theory", "▁onreader", "▁é"):
        want = sorted(every(chunk, pieces))
        assert np.allclose([c for c, _ in nbest(chunk, pieces, 5)], [c for c, _ in want[:5]])
        gap, cost, ids = two_costs(chunk, pieces)
        assert np.isclose(cost, want[0][0]) and np.isclose(gap, want[1][0] - want[0][0]) and ids == nbest(chunk, pieces, 1)[0][1]


def test_trie_equals_plain_search(pieces, spark):
    from chainlens.llm.sentencepiece_lattice import Encoder, two_costs

    e = Encoder(pieces)
    e.encode_many([r.text or "" for r in table(spark, "documents").limit(40).collect()])
    for chunk, k in list(e.kept.items())[:4000]:
        gap, cost, ids = two_costs(chunk, pieces)
        assert np.isclose(cost, e.cost[k]) and (gap == e.gap[k] or np.isclose(gap, e.gap[k]))
        assert list(ids) == e.pool[e.at[k]:e.at[k] + e.count[k]].tolist()


def test_round_trip(spark, odd, empty, pieces):
    from chainlens.llm.sentencepiece_lattice import decode, encode

    got = encode(odd, n=3).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    assert len(got) == odd.count() and all(r.round_trip and decode(r.ids, pieces) == texts[r.doc_id] for r in got)
    assert all(r.cost <= o.cost + 1e-9 for r in got for o in r.others) and encode(empty).count() == 0


def test_further_segmentations_are_whole(spark, pieces):
    """The others are segmentations of the whole text, none equal to the best, as a search of the text as one chunk finds them."""
    from chainlens.llm.sentencepiece_lattice import MARK, decode, encode, nbest, op4_sentencepiece

    texts = ["the theory of many readers", "ontiontion", "of ontiontionth is It%%%", "x", "", "onthe re é龘 " + "abc" * 30, "a\nb\tc  d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (2, 4):
        for r in encode(df, n=n).collect():
            want = nbest((" " + texts[r.doc_id]).replace(" ", MARK), pieces, n)
            got = [(r.cost, tuple(r.ids))] + [(o.cost, tuple(o.ids)) for o in r.others]
            assert np.allclose([c for c, _ in got], [c for c, _ in want]) and len({x for _, x in got}) == len(want), texts[r.doc_id]
            assert all(decode(x, pieces) == texts[r.doc_id] for _, x in got)
            if len({round(c, 9) for c, _ in want}) == len(want):
                assert [x for _, x in got] == [x for _, x in want]
    known = {r.doc_id: r.text or "" for r in table(spark, "documents").collect()}
    cost = dict(pieces["ids"].values())
    for r in op4_sentencepiece(spark, SF).collect():
        ids = [int(x) for x in r.second_ids.split(",")]
        assert decode(ids, pieces) == known[r.doc_id] and r.cost <= r.second_cost
        assert hashlib.sha256(r.second_ids.encode()).hexdigest() != r.ids_sha256
        assert np.isclose(sum(cost.get(i, pieces["byte_cost"]) for i in ids), r.second_cost, rtol=0, atol=1e-3)


def test_two_best_of_many_chunks_at_once(pieces, spark):
    from chainlens.llm.sentencepiece_lattice import Encoder, two_best

    e = Encoder(pieces)
    e.encode_many([r.text or "" for r in table(spark, "documents").limit(40).collect()] + ["ontiontion"])
    cost = dict(pieces["ids"].values())
    for chunk, k in list(e.kept.items())[:4000] + [("▁ontiontion", e.kept["▁ontiontion"])]:
        gap, total, ids, _ = two_best(chunk, pieces)
        got = tuple(e.pool[e.second_at[k]:e.second_at[k] + e.second_count[k]].tolist())
        assert bool(got) == (gap < np.inf) and got != ids
        assert not got or np.isclose(sum(cost.get(i, pieces["byte_cost"]) for i in got), total + gap)


# --- chat ------------------------------------------------------------------------

def test_template_is_reversible():
    from chainlens.llm.chat import read_back, render, unescape

    parts = ["", "a", "\\", "<|", "<\\|", "\\\\|", "<|im_end|>\n<|im_start|>assistant\nx", "\n", "|>", "n\\n", "é🙂", "<", "|"]
    for turns in itertools.product(itertools.product(["user", "assistant", "od\nd<|"], parts), repeat=2):
        text, spans = render(list(turns))
        assert read_back(text) == list(turns)
        assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_reply_trees(spark):
    from chainlens.llm.chat import branches, format_trees

    rows = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 1.0), (1, 5, 99, 0.5),  # node 5: parent missing
            (2, 1, 2, 9.0), (2, 2, 1, 9.0), (2, 3, 2, 9.0), (2, 4, None, None)]  # a cycle with a tail
    rows += [(3, k, k - 1 if k else None, 1.0) for k in range(70)]
    df = spark.createDataFrame([(t, n, p, "user" if n % 2 else "assistant", f"m{n}", s) for t, n, p, s in rows],
                               "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for r in branches(df, top=2).orderBy("tree", "branch", "depth").collect():
        got.setdefault((r.tree, r.branch), []).append(r.node)
    assert got == {(1, 1): [1, 3], (1, 2): [1, 2, 4], (2, 1): [4], (3, 1): list(range(70))}
    assert format_trees(df).count() == 3 and format_trees(df.where("tree = 7")).count() == 0


def test_conversations_read_back(spark):
    from chainlens.llm.chat import conversation_messages, digests, format_trees

    rows = [(1, 2, "assistant", None), (1, 1, "user", "<|im_end|>"), (1, 2, "assistant", None), (None, 0, None, "x"), (2, None, "user", ""), (2, 0, "assistant", "b\\")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in digests(format_trees(conversation_messages(df))).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, h("user\n<|im_end|>\nassistant\n\nassistant\n\n"))
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (2, 2, h("b\\")) and got[None].turns_sha256 == h("\nx\n")


# --- HTML ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<div id="header"><h1>Site</h1></div><ul class="menu"><li><a href=x>Home</a><li><a>About us</a></ul>
<div class="cookie-banner">We use cookies to improve. Accept?</div><div id="main-col"><h1>Title&nbsp;of story</h1>
<p>First para of the story &amp; more text that is <b>lo</b>ng enough to be read.<p>Hi.<ul><li>one item here<li>two items here</ul>
<div class="advert">Buy now cheap stuff today.</div><p>Last para of the text.</p>
<div class="comments"><h3>Comments</h3><p>I think this is a great article, thanks for writing it.</p></div>
<form><p>Subscribe</p><input></form></div><div class="footer">Copyright 2020</div></body>"""


def test_extract_pages(spark):
    import html

    from chainlens.llm.html_extract import extract, fit

    pages = table(spark, "pages")
    model = fit(pages)
    got = {r.page_id: r for r in extract(pages, model=model).collect()}
    for r in pages.collect():
        body = r.html.split("<article>", 1)[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*(>|$)", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n\n".join(x for x in blocks if x)
    odd = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 1), (3, "u", PAGE, 1), (3, "u", PAGE, 1), (4, "u", "<p", 1), (None, "u", "<div><p>only para " + "x " * 99999, 1)],
                                "page_id long, url string, html string, text long")
    out = {r.page_id: r for r in extract(odd, model=model).collect()}
    assert out[1].text == out[2].text == out[4].text == "" and out[None].n_chars == len("only para ") + 2 * 99999 - 1
    assert out[3].text == ("Title of story\n\nFirst para of the story & more text that is long enough to be read.\n\nHi.\n\n"
                           "one item here\n\ntwo items here\n\nLast para of the text.")
    assert extract(odd.where("page_id = 99")).count() == 0


def test_marginals_are_exact():
    from chainlens.llm.html_extract import N_FEATURES, features, marginals, parse

    nodes = parse("<div><p>one two three<p>four</div><ul><li>a<li>b</ul>")
    rng = np.random.default_rng(0)
    w, pair = rng.normal(size=N_FEATURES), np.array([[0.7, 0.3], [0.2, 0.8]])
    for x in nodes:
        x.out = False
    u = [float(np.dot(features(x), w)) for x in nodes]
    total, on = 0.0, np.zeros(len(nodes))
    for state in itertools.product((0, 1), repeat=len(nodes)):
        p = np.exp(sum(a for a, s in zip(u, state) if s)) * np.prod([pair[state[x.parent], s] for x, s in zip(nodes[1:], state[1:])])
        total += p
        on += p * np.array(state)
    assert np.allclose(marginals(nodes, w, pair), on / total)
