"""Benchmark decontamination by template canonicalisation.

Texts become sequences of words in which numbers, names and units are typed
placeholders; punctuation, case and white space do not count. Windows of five words
of documents and benchmark items are hash-joined, and a (document, item) pair is
checked for slot consistency: along an alignment each value of the item must always
stand for the same value of the document, and the other way round. So verbatim
copies and re-parameterised questions are caught by one join.

What is a name depends on case and punctuation, so a window with names is joined in
two forms: with the names as placeholders and with the names as lower-case words. A
window that has too few fixed words even then is joined on its raw words, numbers
included; so every position of an item has a window. An item under five words is one
window of its raw words.

A window that more than eight items hold (a prompt such as "choose the best answer", or
an item that stands in the benchmark many times) says nothing about one of them: each
item is sought by the windows that are its own or nearly so. Items that have no such
window are classes by their set of windows, and the smallest id of a class stands for
it. So a document that holds a prompt alone is no hit of ``contaminated``, and no window
joins a document with more items than that. ``shared_links`` does the rest exactly, by all
windows of all items, between classes of documents and of items that have the same
windows; ``leaks`` adds it as one row per document with the number of its items.

Before the shuffle the windows of documents pass a Bloom filter of the benchmark's
windows. Its size is fixed (512 KB) whatever the benchmark's; a larger benchmark only
lets more windows through to the join, the results are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import keyed, materialize, real_id
from chainlens.llm.textscan import Scanner, byte_slices, hash_of, lower_bytes, mix, windows

WINDOW, CONTAINED, RUN_WORDS, MIN_LITERALS = 5, 0.8, 13, 3
#: a window of more items than these is a prompt of the benchmark, not a sign of one item
SHARED_BY = 8
BLOOM_BITS = 1 << 22
#: forms of a window: names as placeholders, names as words, raw words (-k: a whole item of k words)
TEMPLATE, WORDS, RAW = 0, 1, 2
_RAW_SALT = 0xC2B2AE3D27D4EB4F
#: fixed values: words that are units when they follow a number
UNITS = ("mm cm m km in inch inches ft feet foot yd yards mi mile miles mg g gram grams kg kilogram kilograms t "
         "tons lb lbs oz ml cl l liter liters litre litres s sec second seconds min minute minutes h hr hrs hour "
         "hours day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur "
         "mph kmh kph v w kw kwh hz khz mhz ghz kb mb gb tb k c f degrees").split()


def _classes() -> np.ndarray:
    c = np.zeros(256, dtype=np.uint8)
    c[48:58] = 1
    c[65:91] = c[97:123] = c[128:] = 2
    return c


class Canon:
    """Canonical words of a slice of texts."""

    def __init__(self):
        self.scan = Scanner(_classes())
        self.units = np.sort(np.array([hash_of(u) for u in UNITS], dtype=np.uint64))
        ends = np.zeros(256, dtype=bool)
        ends[[ord(c) for c in ".!?:;\n"]] = True
        self.ends = ends
        self.slot = mix(np.arange(1, 5, dtype=np.uint64))  # number, name, unit

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(start, end, row, hash of the word, kind, lower bytes): kind 0 literal, 1 number, 2 name, 3 unit."""
        low = lower_bytes(data)
        start, end, row = self.scan.words(data, offsets)
        if not len(start):
            return start, end, row, np.zeros(0, np.uint64), np.zeros(0, np.uint8), low
        number = self.scan.classes[data[start]] == 1
        # digits joined by one point or comma are one number
        tied = (number[1:] & number[:-1] & (row[1:] == row[:-1]) & (start[1:] == end[:-1] + 1)
                & np.isin(data[end[:-1]], [44, 46]))
        if tied.any():
            start, end = start[np.append(True, ~tied)], end[np.append(~tied, True)]
            row, number = row[np.append(True, ~tied)], number[np.append(True, ~tied)]
        h = self.scan.hashes(low, start, end)
        kind = np.zeros(len(start), dtype=np.uint8)
        kind[number] = 1
        # a capital letter, then none, away from the start of a sentence: a name
        padded = np.append(low != data, [False, False, False])
        wide = (data[start] >= 0x80).astype(np.int64)
        first, second = padded[start + wide], padded[start + 2 * wide + 1 - wide] & (start + 1 + wide < end)
        stops = np.concatenate([[0], np.cumsum(self.ends[data], dtype=np.int64)])
        initial = np.ones(len(start), dtype=bool)
        initial[1:] = (stops[start[1:]] > stops[end[:-1]]) | (row[1:] != row[:-1])
        kind[first & ~second & ~initial & ~number] = 2
        after = np.zeros(len(start), dtype=bool)
        after[1:] = number[:-1] & (row[1:] == row[:-1])
        at = np.nonzero(after & ~number)[0]
        kind[at[np.isin(h[at], self.units)]] = 3
        return start, end, row, h, kind, low

    def forms(self, h: np.ndarray, kind: np.ndarray, row: np.ndarray, short: list[int]):
        """(form, positions, window hashes): each window in its forms, and the runs of ``short`` widths."""
        slot = self.slot[np.maximum(kind, 1) - 1]
        n = len(h) - WINDOW + 1
        if n > 0:
            count = lambda x: sum(x[k:k + n].astype(np.int8) for k in range(WINDOW))
            whole = row[:n] == row[WINDOW - 1:]
            fixed, names = count(kind == 0), count(kind == 2)
            rich = fixed + names >= MIN_LITERALS
            for form, good, words in ((TEMPLATE, fixed >= MIN_LITERALS, np.where(kind == 0, h, slot)),
                                      (WORDS, rich & ((names > 0) | (fixed < MIN_LITERALS)), np.where(kind % 2 == 0, h, slot)),
                                      (RAW, ~rich, h)):
                at = np.nonzero(whole & good)[0]
                w = windows(words, WINDOW)[at]
                yield form, at, mix(w ^ np.uint64(_RAW_SALT)) if form == RAW else w
        for k in short:
            if len(h) >= k:
                at = np.nonzero(row[:len(h) - k + 1] == row[k - 1:])[0]
                yield -k, at, mix(windows(h, k)[at] ^ np.uint64(_RAW_SALT + k))


def _bloom_bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BLOOM_BITS - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def template_windows(texts: DataFrame, key: list[str], bloom: np.ndarray | None = None, short: list[int] | None = None) -> DataFrame:
    """(key columns, pos, h, slots, form): the windows of ``text``, those that pass ``bloom`` if there is one.

    ``slots`` has kind:value for each placeholder of the window (of the numbers and units
    in the forms that keep names). ``short``: the widths below five whose runs of raw words
    are wanted; None: for a text of fewer than five words the whole text.
    """
    schema = ", ".join([f"{k} long" for k in key] + ["pos int", "h long", "slots array<string>", "form int"])
    names = [*key, "pos", "h", "slots", "form"]

    def run(batches):
        canon = Canon()
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(key))]
            for at, data, off in byte_slices(b.column(len(key))):
                start, end, row, h, kind, low = canon(data, off)
                size = np.bincount(row, minlength=1)
                for form, hit, w in canon.forms(h, kind, row, list(range(1, WINDOW)) if short is None else short):
                    if form < 0 and short is None:
                        whole = size[row[hit]] == -form
                        hit, w = hit[whole], w[whole]
                    if bloom is not None:
                        x, y = _bloom_bits(w)
                        good = (bloom[x >> 3] >> (x & 7).astype(np.uint8)) & (bloom[y >> 3] >> (y & 7).astype(np.uint8)) & 1 == 1
                        hit, w = hit[good], w[good]
                    if not len(hit):
                        continue
                    pos = hit - np.searchsorted(row, row[hit], "left")
                    slots = [[f"{kind[j]}:{low[start[j]:end[j]].tobytes().decode('utf-8', 'replace')}"
                              for j in range(i, i + WINDOW) if kind[j] and (form == TEMPLATE or kind[j] != 2)] if form >= 0 else []
                             for i in hit.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[at + row[hit]], pa.int64()) for c in cols]
                        + [pa.array(pos, pa.int32()), pa.array(w.view(np.int64), pa.int64()),
                           pa.array(slots, pa.list_(pa.string())), pa.array(np.full(len(hit), form), pa.int32())], names)

    return texts.select(*key, "text").mapInArrow(run, schema)


def window_bloom(h: DataFrame) -> np.ndarray:
    """The Bloom filter of a column h; at most BLOOM_BITS / 64 rows reach the driver."""
    mask = BLOOM_BITS - 1
    bits = h.select(F.explode(F.array(
        F.col("h").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(mask)))).alias("b"))
    words = bits.groupBy(F.floor(F.col("b") / 64).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))).alias("v"))
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    for r in words.collect():
        out[r.w] = r.v
    return out.view(np.uint8)


def align(matches: list, poor=()) -> tuple[set, int, bool]:
    """(item windows matched consistently, words of the longest run, whether values were replaced).

    ``matches``: (dpos, ipos, document slots, item slots). On each alignment
    (dpos - ipos) a value stands for the value it is paired with most often; windows
    that contradict this do not count. Of the forms in which a window matched, the one
    with most placeholders is checked. A run goes on where the next window leaves no
    word uncovered, or where all windows between are ``poor`` (positions whose raw words
    alone could match); words that no window covers are not counted.
    """
    lines: dict[int, dict[int, tuple]] = {}
    for m in matches:
        line, new = lines.setdefault(m["dpos"] - m["ipos"], {}), (tuple(m["islots"]), tuple(m["dslots"]))
        if m["ipos"] not in line or len(new[0]) > len(line[m["ipos"]][0]):
            line[m["ipos"]] = new
    seen, longest, replaced, poor = set(), 0, False, set(poor)
    for line in lines.values():
        votes: dict[tuple, int] = {}
        for islots, dslots in line.values():
            for pair in set(zip(islots, dslots)):
                votes[pair] = votes.get(pair, 0) + 1
        to, back = {}, {}
        for (i, d), n in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
            to.setdefault(i, d)
            back.setdefault(d, i)
        ok = sorted(p for p, (i, d) in line.items() if all(to[a] == b and back[b] == a for a, b in zip(i, d)))
        run, last = 0, None
        for p in ok:
            joined = last is not None and (p - last <= WINDOW or all(x in poor for x in range(last + 1, p)))
            run = run + min(WINDOW, p - last) if joined else WINDOW
            last, longest = p, max(longest, run)
            replaced |= line[p][0] != line[p][1]
        seen.update(ok)
    return seen, longest, replaced


def judge(matches: list, n_windows: int) -> tuple[int, int, bool]:
    """``align`` with the number of windows."""
    seen, longest, replaced = align(matches)
    return len(seen), longest, replaced


def own_windows(bench: DataFrame, shared_by: int = SHARED_BY) -> DataFrame:
    """(columns of ``bench``, members): the windows that at most ``shared_by`` items hold; of items
    without any, all windows of one item (the smallest id) for each set of windows. ``members``:
    how many items a row's item stands for."""
    held = bench.groupBy("h").agg(F.countDistinct("item").alias("items"))
    marked = bench.join(held, "h").withColumn("own", F.col("items") <= shared_by).drop("items")
    windows = F.sort_array(F.collect_set(F.struct("h", "form")))
    by_item = marked.groupBy("item").agg(F.max("own").alias("has_own"), F.xxhash64(windows).alias("windows"))
    one = by_item.where("not has_own").groupBy("windows").agg(F.min("item").alias("item"), F.count("*").alias("members"))
    keep = by_item.where("has_own").select("item", "has_own", F.lit(1).cast("long").alias("members")).unionByName(
        one.select("item", F.lit(False).alias("has_own"), "members"))
    return marked.join(keep, "item").where("own or not has_own").drop("own", "has_own")


def prompts(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", shared_by: int = SHARED_BY) -> DataFrame:
    """(items, item_id, positions): the shared stretches of a benchmark as classes: the number of items
    that hold a set of windows in common, the smallest of them, and where its windows stand in it."""
    items = keyed(benchmark, item_col, item_text).withColumnRenamed("did", "item")
    bench = template_windows(items, ["item"]).where(F.col("form") == TEMPLATE)
    held = bench.groupBy("h").agg(F.countDistinct("item").alias("items"), F.min("item").alias("item"), F.xxhash64(
        F.sort_array(F.collect_set("item"))).alias("holders"))
    first = bench.groupBy("item", "h").agg(F.min("pos").alias("pos"))
    return (held.where(F.col("items") > shared_by).join(first, ["item", "h"]).groupBy("holders", "items", "item")
            .agg(F.sort_array(F.collect_list("pos")).alias("positions"))
            .select("items", real_id(F.col("item")).alias("item_id"), "positions"))


def _found(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(windows of ``docs`` that are in ``bench``, sizes of the items, windows of the items)."""
    at = lambda form: F.sort_array(F.collect_set(F.when(F.col("form") == form, F.col("pos"))))
    sizes = bench.groupBy("item").agg(F.countDistinct("pos").alias("n_all"), at(TEMPLATE).alias("templates"),
                                      at(RAW).alias("poor"), F.min("form").alias("least"), F.max("members").alias("members"))
    short = [-r.form for r in bench.where("form < 0").select("form").distinct().collect()]
    parts = bench.select("item", F.col("pos").alias("ipos"), "h", F.col("slots").alias("islots"))
    base = keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    found = template_windows(base, ["did", "th"], window_bloom(bench), sorted(short))
    found = found.select("did", "th", F.col("pos").alias("dpos"), "h", F.col("slots").alias("dslots"))
    return found, sizes, parts


def _judged(found: DataFrame, bench: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (did, th, item) that pass, with their figures."""
    share_of = lambda n: F.ceil(n * CONTAINED)
    n_templates = F.size("templates")
    # a run of 13 words is covered by three windows at least
    needed = F.least(share_of(F.col("n_all")), F.when(n_templates > 0, share_of(n_templates)), F.lit(-(-RUN_WORDS // WINDOW)))
    pairs = (found.join(bench, "h").groupBy("did", "th", "item")
             .agg(F.collect_set(F.struct("dpos", "ipos", "dslots", "islots")).alias("m"))
             .join(sizes, "item").where(F.size("m") >= needed)
             .select("did", "th", "item", "n_all", "m", "templates", "poor", "least", "members"))

    def run(batches):
        for b in batches:
            rows = []
            for n, m, templates, poor, least in zip(*(b.column(i).to_pylist() for i in range(3, 8))):
                seen, longest, replaced = align(m, poor)
                total, hit, part = n, len(seen), len(seen.intersection(templates))
                if templates and part * total > hit * len(templates):
                    total, hit = len(templates), part
                rows.append((total, hit, longest if least >= 0 or not longest else -least, replaced))
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(3)]
                + [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.bool_()), b.column(8)],
                ["did", "th", "item", "n_windows", "n_matched", "run_words", "replaced", "members"])

    judged = pairs.mapInArrow(run, "did long, th long, item long, n_windows long, n_matched long, run_words long, replaced boolean, "
                              "members long")
    share = F.col("n_matched") / F.col("n_windows")
    return judged.where((share >= CONTAINED) | (F.col("run_words") >= RUN_WORDS)).withColumn("containment", share)


def _public(judged: DataFrame) -> DataFrame:
    return judged.select(real_id(F.col("did")).alias("doc_id"), "th", real_id(F.col("item")).alias("item_id"),
                         "n_windows", "n_matched", "containment", "run_words", "replaced", "members")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", shared_by: int = SHARED_BY) -> DataFrame:
    """(doc_id, th, item_id, n_windows, n_matched, containment, run_words, replaced, members): leaked items by document.

    A pair is reported when at least 0.8 of the item's windows are in the document,
    consistently, or a run of at least 13 words is. The share is taken over all windows
    of the item or over those with three fixed words (which alone can match when values
    are replaced), whichever is larger; ``n_windows`` and ``n_matched`` are of that base.
    Windows that more than ``shared_by`` items hold count only for items that have no other
    (``members``: the items with the same windows that the row stands for, 1 else); an
    item under five words is one window of its raw words. Null or empty texts match
    nothing. Repeated rows are reported once (``th`` is the hash of the text). Null ids
    come back null. Empty tables: empty result.
    """
    items = keyed(benchmark, item_col, item_text).withColumnRenamed("did", "item")
    bench = materialize(own_windows(template_windows(items, ["item"]).distinct(), shared_by), "bench-windows")
    found, sizes, parts = _found(docs, bench, id_col, text_col)
    return _public(_judged(found, parts, sizes))


def item_classes(bench: DataFrame) -> DataFrame:
    """(columns of ``bench``, members): all windows of one item (the smallest id) for each set of placed
    windows, with the number of items that have that set."""
    placed = F.sort_array(F.collect_set(F.struct("h", "form", "pos", "slots")))
    one = bench.groupBy("item").agg(F.xxhash64(placed).alias("windows")).groupBy("windows").agg(
        F.min("item").alias("item"), F.count("*").alias("members"))
    return bench.join(one.select("item", "members"), "item")


def shared_links(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", shared_by: int = SHARED_BY) -> tuple[DataFrame, DataFrame] | None:
    """What the shared windows hide from ``contaminated``, with no window left out: (links of classes, classes).

    Every document that holds a window of more than ``shared_by`` items is judged by all its
    windows against all windows of all items. Documents whose windows are the same at the
    same distances are one class, and so are items; each pair of classes is judged once.
    Links: (class_id, item, its figures, members); classes: (did, th, class_id). None if no window is shared."""
    items = keyed(benchmark, item_col, item_text).withColumnRenamed("did", "item")
    every = materialize(template_windows(items, ["item"]).distinct(), "all-windows")
    shared = every.groupBy("h").agg(F.countDistinct("item").alias("n")).where(F.col("n") > shared_by).select("h")
    if shared.isEmpty():
        return None
    found, sizes, parts = _found(docs, materialize(item_classes(every), "item-classes"), id_col, text_col)
    found = materialize(found.distinct().join(every.select("h").distinct(), "h", "left_semi"), "found-windows")
    found = found.join(found.join(shared, "h", "left_semi").select("did", "th").distinct(), ["did", "th"], "left_semi")
    by_doc = found.groupBy("did", "th").agg(F.min("dpos").alias("first"), F.sort_array(F.collect_set(F.struct("h", "dpos", "dslots"))).alias("w"))
    same = F.xxhash64(F.transform("w", lambda x: F.struct(x["h"], x["dpos"] - F.col("first"), x["dslots"])))
    classes = materialize(by_doc.select("did", "th", same.alias("class_id")), "document-classes")
    one = classes.groupBy("class_id").agg(F.min(F.struct("did", "th")).alias("one")).select("class_id", "one.*")
    judged = _judged(found.join(one, ["did", "th"], "left_semi"), parts, sizes)
    return materialize(judged.join(one, ["did", "th"]).drop("did", "th"), "class-links"), classes


def leaks(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """All that leaked: the rows of ``contaminated`` (``class_id`` null) and, for each document that
    shared windows link to items, one row with its class (``class_id``), the item it holds most of,
    and in ``members`` the number of all items it is linked to; ``shared_links`` lists them by class."""
    own = contaminated(docs, benchmark, **kw).withColumn("class_id", F.lit(None).cast("long"))
    rest = shared_links(docs, benchmark, **kw)
    if rest is None:
        return own
    links, classes = rest
    figures = ["n_windows", "n_matched", "containment", "run_words", "replaced"]
    best = F.max_by(F.struct("item", *figures), F.struct("containment", "run_words", -F.col("item")))
    of_class = links.groupBy("class_id").agg(best.alias("best"), F.sum("members").alias("members"))
    return own.unionByName(classes.join(of_class, "class_id").select("did", "th", "class_id", "best.*", "members").select(
        real_id(F.col("did")).alias("doc_id"), "th", real_id(F.col("item")).alias("item_id"), *figures, "members", "class_id"))


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.drop("th")
