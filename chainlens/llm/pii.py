"""Personal data, by information-theoretic sanitisation, in DataFrame functions only.

Base entities (email, ip, card, phone) are found by regular expressions that run
in linear time on any text (possessive groups; a match may only start where a run
starts or where the last match ended). Every occurrence of an entity value is a
redaction site. The documents of the whole corpus that hold a term, and those of
them that hold an entity, anywhere, give log2(P(entity | term) / P(entity)), the
bits a term of the document still tells about the removed entity; as a share of the
entity's -log2 P it is the term's disclosure. P(entity | term) is shrunk towards
P(entity) by the weight of one document, so a term seen once tells less than one
seen often, but no number of documents is asked for. Terms over the threshold are
generalised, and those that as good as name the entity are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import keyed, materialize, real_id

KINDS = ("email", "ip", "card", "phone")
#: start of a run of the class, or the end of the last match
_EMAIL_CHARS = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_EMAIL_CHARS}]))[{_EMAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-](?:[\x20().-]*+[0-9])++",
}
#: a cheap test that a text can hold the kind at all
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: documents that the prior P(entity) weighs as much as
PRIOR_DOCS = 1.0
GENERALISE, REMOVE = 0.8, 0.95
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}++(?!\.?[\p{L}\p{N}@_%+-])"
_BLOCK = 256
_NO_SPANS = "array<struct<start:bigint,end:bigint,value:string,left:string,right:string>>"


def _before(lens: Column, i: Column) -> Column:
    """Sum of the first i lengths, by block sums, so that many matches stay near linear."""
    add = lambda a, x: a + x
    block = F.floor(i / _BLOCK).cast("int")
    whole = F.aggregate(F.slice(F.col("_sums"), F.lit(1), block), F.lit(0).cast("long"), add)
    return whole + F.aggregate(F.slice(lens, block * _BLOCK + 1, i - block * _BLOCK), F.lit(0).cast("long"), add)


def match_spans(df: DataFrame, text: str, pattern: str, out: str, possible: Column,
                valid=lambda value: F.lit(True), context: int = 0) -> DataFrame:
    """``df`` plus ``out``: array of (start, end, value, left, right) of the matches in ``text``.

    Code points, end exclusive. The text between matches (one split) gives the
    offsets; left and right are up to ``context`` code points of it.
    """
    cols = [c for c in df.columns if c not in ("_m", "_p", "_len", "_sums")]
    none = F.array().cast("array<string>")
    d = df.select(*cols, F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias("_m"))
    d = d.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    d = d.withColumn("_len", F.transform("_m", lambda m, i: (
        F.char_length(m) + F.char_length(F.get(F.col("_p"), i))).cast("long")))
    d = d.withColumn("_sums", F.when(F.size("_m") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_m") - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(F.col("_len"), b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0).cast("long"), lambda a, x: a + x)))
        .otherwise(F.array().cast("array<bigint>")))
    edge = (lambda c, side: F.expr("''") if not context else side(c, F.lit(context)))

    def span(m, i):
        end = _before(F.col("_len"), i + 1)
        left, right = F.get(F.col("_p"), i), F.get(F.col("_p"), i + 1)
        return F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("value"),
                        edge(left, F.right).alias("left"), edge(right, F.left).alias("right"))

    return d.select(*cols, F.when(F.size("_m") == 0, F.array().cast(_NO_SPANS)).otherwise(
        F.filter(F.transform("_m", span), lambda s: valid(s["value"]))).alias(out))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    d = _digits(v)
    each = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(F.char_length(d).between(16, 19), total % 10 == 0).otherwise(False)


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": _luhn,
    "phone": lambda v: F.char_length(_digits(v)).between(8, 15),
}


def _any_span():
    return F.greatest(*(F.size(k) for k in KINDS)) > 0


def _terms(text: Column) -> Column:
    """The hashes of the distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda m: F.xxhash64(F.lower(m))))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, email, ip, card, phone, words): per row the valid spans of each kind, in order,
    and, where there are any, the hashes of the text's terms."""
    d = keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    d = d.withColumn("_digit", F.col("text").rlike("[0-9]"))
    for kind in KINDS:
        possible = F.contains("text", F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
        if kind != "email":
            possible = possible & F.col("_digit")
        d = match_spans(d, "text", PATTERNS[kind], kind, possible, VALID[kind])
    words = F.when(_any_span(), _terms(F.col("text"))).otherwise(F.array().cast("array<bigint>"))
    return d.select("did", "th", *KINDS, words.alias("words"))


def term_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """((term, n_t): the documents of each term), and their number; repeated rows are one document.

    Only the ids of repeated rows go through the shuffle with their terms; the terms of
    all others are counted before it.
    """
    d = keyed(docs, id_col, text_col).select("did", F.xxhash64("text").alias("th"), "text")
    rows = materialize(d.groupBy("did", "th").agg(F.count("*").alias("n")), "pii-rows")
    repeated = rows.where("n > 1").select("did", "th", F.lit(True).alias("again"))
    words = d.join(repeated, ["did", "th"], "left").select(
        F.when(F.col("again"), F.struct("did", "th")).alias("doc"), F.explode(_terms(F.col("text"))).alias("term"))
    n = words.groupBy("term", "doc").agg(F.count("*").alias("n"))
    return n.groupBy("term").agg(F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(1)).alias("n_t")), rows.count()


def disclosing_terms(base: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, terms array<struct<start, end, removed>>): terms over the disclosure threshold.

    Counts are documents (id and text), so copies within a document do not add up.
    Entities that stand in the same documents are one class, so a list of many values
    is paired with the terms around it once; pairs that cannot reach the threshold by
    the term's number of documents are not made.
    """
    ents = None
    for kind in KINDS:
        e = base.select("did", "th", F.explode(kind).alias("s")).select(
            "did", "th", F.xxhash64(F.lit(kind), F.lower("s.value")).alias("entity"))
        ents = e if ents is None else ents.unionByName(e)
    ents = materialize(ents.distinct(), "pii-entities")
    classes = ents.groupBy("entity").agg(F.count("*").alias("n_e"), F.bit_xor(F.xxhash64("did", "th")).alias("_x"))
    classes = classes.select("entity", "n_e", F.xxhash64("n_e", "_x").alias("class"))
    held = materialize(ents.join(classes, "entity").select("did", "th", "class", "n_e").distinct(), "pii-classes")
    counts, total = term_documents(docs, id_col, text_col)
    p_e = F.col("n_e") / max(total, 1)
    # (n_e + a p) / (n_t + a) >= p ** (1 - GENERALISE), solved for n_t; the last digit is left to the test below
    most = F.greatest(F.col("n_e") * 1.0, (F.col("n_e") + PRIOR_DOCS * p_e) * F.pow(p_e, F.lit(GENERALISE - 1)) - PRIOR_DOCS + 1e-6)
    limit = held.agg(F.max(most)).first()[0] or 0.0
    near = base.select("did", "th", F.explode("words").alias("term")).join(counts.where(F.col("n_t") <= limit), "term").distinct()
    pairs = near.join(held, ["did", "th"]).where(F.col("n_t") <= most)
    pairs = materialize(pairs.select("did", "th", "class", "n_e", "term", "n_t"), "pii-pairs")
    p_et = (F.count("*") + PRIOR_DOCS * F.first("n_e") / max(total, 1)) / (F.first("n_t") + PRIOR_DOCS)
    likely = pairs.groupBy("class", "term").agg(p_et.alias("p_et"), (F.first("n_e") / max(total, 1)).alias("p_e"))
    share = F.when(F.col("p_e") < 1, F.log2(F.col("p_et") / F.col("p_e")) / -F.log2("p_e")).otherwise(0.0)
    flagged = likely.select("class", "term", share.alias("share")).where(F.col("share") >= GENERALISE)
    flagged = materialize(pairs.join(flagged, ["class", "term"]).groupBy("did", "th", "term").agg(
        (F.max("share") >= REMOVE).alias("removed")), "pii-flagged")
    texts = keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text")).join(
        flagged.select("did", "th").distinct(), ["did", "th"], "left_semi").dropDuplicates(["did", "th"])
    # a running sum over the pieces of a document stays linear in its length
    pieces = texts.select("did", "th", F.posexplode(F.arrays_zip(
        F.split("text", TERM, -1).alias("gap"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("word"))).alias("pos", "s"))
    size = F.char_length(F.coalesce("s.word", F.lit(""))).cast("long")
    pieces = pieces.select("did", "th", "pos", (F.char_length("s.gap") + size).alias("step"), size.alias("size"),
                           F.xxhash64(F.lower("s.word")).alias("term"))
    end = F.sum("step").over(Window.partitionBy("did", "th").orderBy("pos"))
    sites = pieces.withColumn("end", end).where("size > 0").select("did", "th", "term", (F.col("end") - F.col("size")).alias("start"), "end")
    hits = sites.join(flagged, ["did", "th", "term"])
    return (hits.groupBy("did", "th", "start", "end").agg(F.max("removed").alias("removed"))
            .groupBy("did", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("terms")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, email, ip, card, phone, terms) for every row of ``docs``.

    ``did`` is the id (null: the smallest long), ``th`` the hash of the text. Null or
    empty text: empty arrays. Repeated rows get equal spans and count once in the
    corpus statistics. An empty table gives an empty result.
    """
    base = materialize(base_spans(docs, id_col, text_col), "pii-base")
    terms = disclosing_terms(base, docs, id_col, text_col)
    return base.drop("words").join(terms, ["did", "th"], "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>")))


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): base spans become [KIND], generalised terms [TERM], removed terms nothing.

    Spans that overlap are cut at the end of those before them (a window over the
    spans of one document).
    """
    spans = None
    for kind in (*KINDS, "terms"):
        label = F.when(F.col("s.removed"), "").otherwise("[TERM]") if kind == "terms" else F.lit(f"[{kind.upper()}]")
        s = found.select("did", "th", F.explode(kind).alias("s")).select(
            "did", "th", F.col("s.start").alias("start"), F.col("s.end").alias("end"), label.alias("label")).distinct()
        spans = s if spans is None else spans.unionByName(s)
    w = Window.partitionBy("did", "th").orderBy("start", F.desc("end"), "label")
    spans = spans.withColumn("before", F.coalesce(
        F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cuts = spans.groupBy("did", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end", "label", "before"))).alias("cuts"))
    d = keyed(docs, id_col, text_col).withColumn("th", F.xxhash64("text")).join(cuts, ["did", "th"], "left")
    sub = lambda a, b: F.call_function("substring", F.col("text"), (a + 1).cast("int"), (F.greatest(b - a, F.lit(0))).cast("int"))
    parts = F.transform("cuts", lambda c: F.concat(
        sub(c["before"], c["start"]), F.when(c["end"] > c["before"], c["label"]).otherwise("")))
    last = F.array_max(F.transform("cuts", lambda c: c["end"]))
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(
        F.concat(F.array_join(parts, ""), sub(last, F.char_length("text").cast("long"))))
    return d.select(real_id(F.col("did")).alias("doc_id"), text.alias("text"))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    name = lambda kind: F.transform(kind, lambda s: F.concat_ws(
        ":", F.lit(kind if kind in KINDS else "term"), s["start"].cast("string"), s["end"].cast("string")))
    base = F.concat(*(name(k) for k in KINDS))
    return found.select(
        real_id(F.col("did")).alias("doc_id"),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, name("terms")), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_terms"))
