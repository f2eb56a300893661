"""Token alignment against plain loops over the tokens of the two libraries."""

import hashlib
from collections import Counter

import pytest

from tests.llm.conftest import SF

ODD = ["", None, "one", " lead", "two  spaces", "tab\there \n\nand  lines ", "日本語 テスト 🙂", "a▁b", "nbsp \xa0 x", "<|endoftext|> and <s> </s>",
       "don't we'll  they 're", "x" * 3000, "é é ᠎ q \x1c r\x00s", "word " * 500, " ", "\n", "  z \u0085 y", "ﬁ Ⅳ ²"]


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    from chainlens.llm.token_align import MODEL_A, MODEL_B

    a = Tokenizer.from_file(MODEL_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL_B)


def brute(rows, models):
    from tokenizers.decoders import ByteLevel  # noqa: F401  (the letters of bytes are rebuilt below)

    a_model, b_model = models
    letters = {}
    k = 0
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255:
            letters[chr(x)] = x
        else:
            letters[chr(256 + k)] = x
            k += 1
    docs, links = [], Counter()
    for i, t in rows:
        a = [(x, bytes(letters[c] for c in a_model.id_to_token(x))) for x in a_model.encode(" " + (t or ""), add_special_tokens=False).ids]
        b = [(x, bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x) else b_model.id_to_piece(x).replace("▁", " ").encode())
             for x in b_model.encode(t or "")]
        want = b" " + (t or "").encode()
        if not t or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append((i, [], [], [], []))
            continue
        ends = [{}, {}]
        for side, toks in enumerate((a, b)):
            at = 0
            for n, (x, raw) in enumerate(toks):
                at += len(raw)
                ends[side][at] = (n, x)
        cut = sorted(set(ends[0]) & set(ends[1]))
        pairs = [(ends[0][c][1], ends[1][c][1]) for c in cut]
        groups, pa, pb = [], 0, 0
        for c in cut:
            na, nb = ends[0][c][0] + 1, ends[1][c][0] + 1
            groups.append(",".join(str(x) for x, _ in a[pa:na]) + "|" + ",".join(str(x) for x, _ in b[pb:nb]))
            pa, pb = na, nb
        links.update(pairs)
        docs.append((i, a, b, pairs, groups))
    top = {}
    for (x, y), n in links.items():
        top[y] = max(top.get(y, 0), n)
    out = [(i, len(a), len(b), len(g), len(p), sum(links[q] == top[q[1]] for q in p), sum(links[q] for q in p),
            hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, p, g in docs]
    return sorted(out, key=repr), {(x, y, n, n == top[y]) for (x, y), n in links.items()}


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(COLS).collect()), key=repr)


def test_query_equals_brute_force(spark, models):
    from chainlens.llm.token_align import op11_token_alignment

    out = op11_token_alignment(spark, SF)
    assert out.columns == COLS
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(out) == brute(rows, models)[0]


@pytest.mark.parametrize("pairs,size,kept", [(1 << 21, 1 << 20, 100_000), (50, 600, 30)])
def test_odd_texts(spark, models, monkeypatch, pairs, size, kept):
    """Also with tiny slices, blocks and stores of chunks, so that all of them turn over."""
    from chainlens.llm import token_align as T

    monkeypatch.setattr(T, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(T, "SLICE_BYTES", size)
    monkeypatch.setattr(T, "KEPT_CHARS", kept)
    monkeypatch.setattr(T, "JOINED_CHARS", kept)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "a null id"), (2, "one"), (2, "one")]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, block long, pairs string, did string").repartition(3)
    docs, counted = T.align_tokens(df)
    want, links = brute(rows, models)
    assert got(docs) == want
    assert {tuple(r) for r in counted.collect()} == links
    ids = {r.doc_id: (list(r.ids_a), list(r.ids_b)) for r in docs.collect()}
    assert ids[6] == (models[0].encode(" " + ODD[6], add_special_tokens=False).ids, models[1].encode(ODD[6]))
    assert ids[7] == ([], []) and ids[0] == ([], [])


def test_empty_table(spark):
    from chainlens.llm.token_align import align_tokens

    docs, pairs = align_tokens(spark.createDataFrame([], "doc_id long, text string"))
    assert docs.count() == 0 and pairs.count() == 0


def test_chunks_are_independent(models):
    """Joined ids of the chunks are the ids of the whole text, for both tokenizers."""
    import random

    from chainlens.llm.token_align import Pair, load_tokenizers, tables

    loaded = load_tokenizers()
    assert loaded["chunked"]
    pair, rnd = Pair(loaded, list(tables(loaded)[:2])), random.Random(3)
    letters = list("abzé日🙂'.,-09 \t\n▁") + [" ", " ", " ", "\xa0", " ", "́", "᠎", "'s ", "\x1f", "<|endoftext|>", "  "]
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(1, 60))) for _ in range(1500)]
    for part in (texts[:700], texts[700:701], texts[701:]):
        at = [0, 0]
        got = pair.encode(part)
        for k, t in enumerate(part):
            want = models[0].encode(" " + t, add_special_tokens=False).ids, models[1].encode(t)
            for side in (0, 1):
                n = got[side][1][k]
                assert got[side][0][at[side]:at[side] + n].tolist() == want[side], repr(t)
                at[side] += n
