"""Cross-tokenizer alignment as an Arrow pipeline.

Every text is encoded by two tokenizers, A (byte-level BPE) and B (pieces with byte
fallback). Lists of token ids are flattened with the number of their document; segmented
sums of the byte lengths of tokens give the offset where each token ends; an Acero hash
join on (document, end) finds the offsets where a token of A and one of B both end. These
offsets cut a document into groups, and the two tokens that end there are linked.

Counts of linked id pairs over the corpus: ``Table.group_by`` counts the pairs of a block
(some tens of thousands of texts) inside a task, Spark adds the blocks up and finds the
highest count of each B id. Every block then gets back the counts of its own pairs, one
row per pair and block, and adds them up by document. No table of all pairs is broadcast
or held by a task; a block holds a bounded number of distinct pairs.

Encoding dominates the cost. Both tokenizers decide independently on either side of a
single space between two characters that are not white space (A's pre-tokenizer always
cuts there, and no piece of B holds a space mark after another character, which is
checked), so a worker keeps the ids of short chunks between such spaces.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import keyed, materialize, real_id

MODEL_A, MODEL_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: bytes of text aligned together (a longer text goes alone); pairs of documents, or bytes, that close a block
SLICE_BYTES, BLOCK_PAIRS, BLOCK_BYTES = 1 << 20, 1 << 21, 1 << 24
#: characters of chunks that a task keeps, and of chunks that are encoded as one text
KEPT_CHARS, JOINED_CHARS = 2_500_000, 100_000
#: a single space between two characters that are surely no white space, nor its mark, for any tokenizer
_CUT = re.compile(f"(?<=[^\\s\u180e{MARK}]) (?=[^\\s\u180e{MARK}])")
#: what a chunk that stands between two others neither begins nor ends with, and the mark anywhere
_EDGE = re.compile(f"^[\\s\u180e]|[\\s\u180e]\\Z|{MARK}")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def load_tokenizers(model_a: str = MODEL_A, model_b: str = MODEL_B) -> dict:
    """{json, model, bytes_a, bytes_b}: the files' contents and the bytes of every id (driver side)."""
    import sentencepiece

    with open(model_a, encoding="utf-8") as f:
        text = f.read()
    with open(model_b, "rb") as f:
        model = f.read()
    spec = json.loads(text)
    vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    letters, added = byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    bytes_a = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        bytes_a[i] = token.encode() if token in added else bytes(letters[c] for c in token)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode()
               for i in range(sp.get_piece_size())]
    crossing = any(re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)) for i in range(sp.get_piece_size()))
    pre = spec.get("pre_tokenizer") or {}
    chunked = not crossing and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
    return {"json": text, "model": model, "bytes_a": bytes_a, "bytes_b": bytes_b, "chunked": bool(chunked)}


class Pair:
    """The two tokenizers of a task, and the ids of the chunks they met: (pool, place, count) for A and B."""

    def __init__(self, loaded: dict, length: list[np.ndarray]):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(loaded["json"])
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=loaded["model"])
        self.chunked, self.length = loaded["chunked"], length
        self._start([], [(np.zeros(0, np.int32), np.zeros(0, np.int64))] * 2)

    def _start(self, names: list[str], lists: list[tuple[np.ndarray, np.ndarray]]):
        self.names, self.number, self.chars, self.ids = [], {}, 0, [(np.zeros(0, np.int32), *[np.zeros(0, np.int64)] * 2)] * 2
        self._add(names, lists)

    def _add(self, names: list[str], lists: list[tuple[np.ndarray, np.ndarray]]):
        """Keep chunks with their (ids, counts) of A and of B."""
        self.number.update(zip(names, range(len(self.names), len(self.names) + len(names))))
        self.names += names
        self.chars += sum(map(len, names))
        self.ids = [(np.concatenate([pool, ids]), np.concatenate([place, len(pool) + np.cumsum(n) - n]), np.concatenate([count, n]))
                    for (pool, place, count), (ids, n) in zip(self.ids, lists)]

    def _of(self, k: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, counts) of A and of B for the chunks with these numbers."""
        return [(pool[ranges(place[k], count[k])], count[k]) for pool, place, count in self.ids]

    def _alone(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        a = [e.ids for e in self.a.encode_batch([" " + t for t in chunks], add_special_tokens=False)]
        return [(np.array(list(itertools.chain.from_iterable(x)), dtype=np.int32), np.array([len(y) for y in x], dtype=np.int64))
                for x in (a, self.b.encode(chunks, num_threads=1))]

    def _joined(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """As _alone, for chunks that may stand side by side: one text, cut again where the chunks end."""
        text = " ".join(chunks)
        want = np.cumsum([len(c.encode("utf-8", "surrogatepass")) + 1 for c in chunks])
        out = []
        for ids, length in zip((self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)), self.length):
            ids = np.array(ids, dtype=np.int32)
            end = np.cumsum(length[ids])
            at = np.searchsorted(end, want)
            if at[-1] != len(end) - 1 or (end[at] != want).any():
                return None
            out.append((ids, np.diff(at, prepend=-1)))
        return out

    def _learn(self, new: list[str]):
        plain = [bool(c) and not _EDGE.search(c) for c in new] if self.chunked else [False] * len(new)
        odd = [c for c, ok in zip(new, plain) if not ok]
        new = [c for c, ok in zip(new, plain) if ok]
        for lo, hi in slices([len(c) for c in new], JOINED_CHARS):
            self._add(new[lo:hi], self._joined(new[lo:hi]) or self._alone(new[lo:hi]))
        if odd:
            self._add(odd, self._alone(odd))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all texts, number of each text's) of A for space + text and of B for text, which adds the space."""
        chunks: list[str] = []
        first = [0]
        for t in texts:
            if self.chunked:
                parts = _CUT.split(" " + t)
                parts[0] = parts[0][1:]
                chunks += parts
            else:
                chunks.append(t)
            first.append(len(chunks))
        if self.chars > KEPT_CHARS:  # keep what the texts before had
            k = np.unique(self.last)
            names = [self.names[i] for i in k.tolist()]
            few = sum(map(len, names)) <= KEPT_CHARS // 2
            self._start(names if few else [], self._of(k if few else k[:0]))
        self._learn(list(set(chunks).difference(self.number)))
        self.last = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        out = []
        for ids, count in self._of(self.last):
            out.append((ids, np.diff(np.concatenate([[0], np.cumsum(count)])[first])))
        return out


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... (count of them) of all pairs in a row."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(count) - count), count)


def flat(ids: np.ndarray, count: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all ids, their parent document) of a list per document."""
    col = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(ids, pa.int32()))
    return pc.list_flatten(col), pc.list_parent_indices(col).to_numpy(zero_copy_only=False)


def ends(ids: pa.Array, parent: np.ndarray, n: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end of every token counted from its document's start, bytes of every document)."""
    total = np.cumsum(length[ids.to_numpy()])
    upto = np.cumsum(np.bincount(parent, minlength=n))
    whole = np.concatenate([[0], total])[upto]
    before = np.concatenate([[0], whole[:-1]])
    return total - before[parent], whole - before


def spelled(ids: pa.Array, surface: pa.Array) -> bytes:
    """The bytes of all tokens in a row: the data buffer of the taken surfaces."""
    got = pc.take(surface, ids)
    if isinstance(got, pa.ChunkedArray):
        got = got.combine_chunks()
    off = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1] if len(got) else np.zeros(1, np.int64)
    return got.buffers()[2].to_pybytes()[off[0]:off[-1]] if len(got) and got.buffers()[2] is not None else b""


def common_ends(pa_doc: np.ndarray, a_end: np.ndarray, pb_doc: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token number in A, token number in B) of all tokens that end together, in order: a hash join on (document, end)."""
    a = pa.table({"doc": pa_doc, "end": a_end, "a": np.arange(len(a_end), dtype=np.int32)})
    b = pa.table({"doc": pb_doc, "end": b_end, "b": np.arange(len(b_end), dtype=np.int32)})
    both = a.join(b, ["doc", "end"], join_type="inner", use_threads=False)
    ia, ib = both["a"].to_numpy(), both["b"].to_numpy()
    by = np.argsort(ia)
    return ia[by], ib[by]


def align(texts: list[str], pair: Pair, length_a: np.ndarray, length_b: np.ndarray, surface_a: pa.Array, surface_b: pa.Array,
          signs: tuple[pa.Array, pa.Array]) -> dict:
    """Tokens, groups and links of some texts: arrays n_a, n_b, n_groups per text, sha256 per text, and per
    link its text and ids (doc, a, b). Texts that are empty, or that a tokenizer does not spell out, have none."""
    n = len(texts)
    lists = pair.encode(texts)
    want = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    good = np.array([bool(t) for t in texts])
    for _ in range(2):
        lists = [(ids[np.repeat(good, count)], count * good) for ids, count in lists]
        a, doc_a = flat(*lists[0])
        b, doc_b = flat(*lists[1])
        end_a, size_a = ends(a, doc_a, n, length_a)
        end_b, size_b = ends(b, doc_b, n, length_b)
        said_a, said_b = spelled(a, surface_a), spelled(b, surface_b)
        if said_a == said_b == b"".join(w for w, ok in zip(want, good) if ok):
            break
        at_a, at_b = (np.concatenate([[0], np.cumsum(s)]) for s in (size_a, size_b))
        good &= np.array([said_a[at_a[i]:at_a[i + 1]] == w and said_b[at_b[i]:at_b[i + 1]] == w for i, w in enumerate(want)], dtype=bool)
    ia, ib = common_ends(doc_a, end_a, doc_b, end_b)
    n_a, n_b = lists[0][1], lists[1][1]
    n_groups = np.bincount(doc_a[ia], minlength=n)
    # the text a1,a2|b1;a3|b2,b3: tokens of A and B in turn by group, each with the sign behind it
    of_a = np.searchsorted(ia, np.arange(len(a)))  # group of each token
    of_b = np.searchsorted(ib, np.arange(len(b)))
    b_upto = np.concatenate([[0], ib + 1])
    a_upto = np.concatenate([[0], ia + 1])
    place_a = np.arange(len(a)) + b_upto[of_a]
    place_b = np.arange(len(b)) + a_upto[of_b + 1] if len(b) else np.zeros(0, np.int64)
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[ia] = sign_b[ib] = 1
    index = np.empty(len(a) + len(b), dtype=np.int64)
    index[place_a] = a.to_numpy() * 2 + sign_a
    index[place_b] = 2 * len(surface_a) + b.to_numpy() * 2 + sign_b
    written = pc.take(signs[0], pa.array(index))
    upto = np.cumsum(n_a + n_b)
    off = np.frombuffer(written.buffers()[1], np.int64)[written.offset:written.offset + len(written) + 1] if len(index) else np.zeros(1, np.int64)
    data = memoryview(written.buffers()[2]) if len(index) else memoryview(b"")
    sha = [hashlib.sha256(data[off[hi - k]:off[hi] - 1]).hexdigest() if k else "" for hi, k in zip(upto.tolist(), (n_a + n_b).tolist())]
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "sha": sha, "doc": doc_a[ia],
            "a": a.to_numpy()[ia], "b": b.to_numpy()[ib], "ids": lists}


def tables(loaded: dict):
    """Byte lengths, surfaces and written ids (with the sign behind them) of both vocabularies."""
    surface = [pa.array(loaded[k], pa.large_binary()) for k in ("bytes_a", "bytes_b")]
    length = [np.array([len(x) for x in loaded[k]], dtype=np.int64) for k in ("bytes_a", "bytes_b")]
    signs = [f"{i}{c}" for k, pair in (("bytes_a", ",|"), ("bytes_b", ",;")) for i in range(len(loaded[k])) for c in pair]
    return length[0], length[1], surface[0], surface[1], (pa.array(signs, pa.large_string()),)


NONE = (np.zeros(0, np.int32), np.zeros(1, np.int64))
STORE = ("block long, did long, n_a long, n_b long, n_groups long, groups_sha256 string, ids_a array<int>, ids_b array<int>, "
         "pairs array<long>, counts array<int>")


def tokens(docs: DataFrame, loaded: dict, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """A row per document with its distinct linked pairs (a << 32 | b) and their counts, and behind the
    documents of each block a row without document (n_a null) with those of the block."""
    base = keyed(docs, id_col, text_col)
    shared = base.sparkSession.sparkContext.broadcast(loaded)

    def run(batches):
        tabs = tables(shared.value)
        pair = Pair(shared.value, list(tabs[:2]))
        task, number, seen = TaskContext.get().partitionId(), 0, []
        held = read = 0

        def counted(doc, key):
            t = pa.table({"doc": doc, "pair": key}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
            return t["doc"].to_numpy(), t["pair"].to_numpy(), t["count_all"].to_numpy()

        def close():
            """The row of a finished block: partial counts of its pairs."""
            t = pa.concat_tables(seen).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return rows([None], [None], [None], [None], [None], [NONE, NONE],
                        np.array([0, t.num_rows]), t["pair"].combine_chunks(), t["n_sum"].combine_chunks())

        def rows(did, n_a, n_b, n_groups, sha, ids, at, pairs, counts):
            k = len(did)
            ids_a, ids_b = (pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(c)]), pa.int32()), pa.array(x, pa.int32())) for x, c in ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, (task << 32) + number)), pa.array(did, pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                 pa.array(n_groups, pa.int64()), pa.array(sha, pa.string()), ids_a, ids_b,
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(pairs, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pc.cast(pa.array(counts), pa.int32()))],
                ["block", "did", "n_a", "n_b", "n_groups", "groups_sha256", "ids_a", "ids_b", "pairs", "counts"])

        for b in batches:
            dids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            size = pc.binary_length(b.column(1)).to_pylist()
            for lo, hi in slices(size, SLICE_BYTES):
                r = align(texts[lo:hi], pair, *tabs)
                doc, key, n = counted(r["doc"], (r["a"].astype(np.int64) << 32) | r["b"])
                by = np.lexsort((key, doc))
                doc, key, n = doc[by], key[by], n[by]
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                none = (NONE[0], np.zeros(hi - lo, np.int64))
                yield rows(dids[lo:hi], r["n_a"], r["n_b"], r["n_groups"], r["sha"], r["ids"] if keep_ids else [none, none], at, key, n)
                t = pa.table({"pair": key, "n": n}).group_by("pair", use_threads=False).aggregate([("n", "sum")])
                seen.append(t.rename_columns(["pair", "n"]))
                held, read = held + len(key), read + sum(size[lo:hi])
                if held >= BLOCK_PAIRS or read >= BLOCK_BYTES:
                    yield close()
                    seen, held, read, number = [], 0, 0, number + 1
        if seen:
            yield close()

    return base.mapInArrow(run, STORE)


def slices(sizes: list[int], most: int):
    """(from, to) of consecutive rows of at most ``most`` in sum (a larger row stands alone)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if len(sizes) > lo:
        yield lo, len(sizes)


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in the corpus, and whether no pair of its B id has more."""
    n = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    n = n.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    top = n.groupBy("b").agg(F.max("n").alias("top"))
    return n.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_a: str = MODEL_A,
                 model_b: str = MODEL_B, keep_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). documents: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, ids_a, ids_b) for every row of ``docs``; pairs: (a, b, n, best) of all linked ids.

    A link is a token of A and a token of B that end at the same byte; its count is that
    of its id pair over the corpus. ``n_best``: links whose pair has the highest count of
    its B id, ties included; ``count_sum``: counts added up over links. Null and empty
    texts, and texts that either tokenizer does not spell out byte for byte, have no
    tokens: zeros, an empty digest and no ids. Special tokens' strings are plain text.
    Repeated rows come back, and count, as often as they came in; an empty table gives
    empty results. Without ``keep_ids`` the id lists are empty.
    """
    store = materialize(tokens(docs, load_tokenizers(model_a, model_b), id_col, text_col, keep_ids), "aligned")
    partial = store.where("n_a is null").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.counts").cast("long").alias("n"))
    counts = materialize(pair_counts(partial), "pair-counts")
    back = partial.select(F.col("block").alias("of"), "pair").join(counts, "pair").select("of", "pair", "n", "best")
    rows = store.where("n_a is not null")
    done = [c for c in rows.columns if c not in ("block", "pairs", "counts")]

    def total(key, docs_of_block: pa.Table, known: pa.Table) -> pa.Table:
        """The documents of a block, with the counts of the block's pairs added up."""
        lists = docs_of_block["pairs"].combine_chunks()
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, np.int64)
        cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        pair = pc.list_flatten(lists).to_numpy()
        k = pc.list_flatten(docs_of_block["counts"].combine_chunks()).to_numpy().astype(np.int64)
        known = known.sort_by("pair")
        at = np.searchsorted(known["pair"].to_numpy(), pair)
        out = docs_of_block.select(done)
        for name, value in (("n_best", known["best"].to_numpy().astype(np.int64)), ("count_sum", known["n"].to_numpy())):
            run = np.concatenate([[0], np.cumsum(k * value[at])])
            out = out.append_column(name, pa.array((run[cut[1:]] - run[cut[:-1]]).astype(np.int64)))
        return out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in done) + ", n_best long, count_sum long"
    found = rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(total, schema)
    found = found.select(
        real_id(F.col("did")).alias("doc_id"), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256", "ids_a", "ids_b")
    pairs = counts.select(F.shiftright("pair", 32).cast("int").alias("a"),
                          F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n", "best")
    return found, pairs


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    out, _ = align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)
    return out.drop("ids_a", "ids_b")
