"""Event-log decoding as native column expressions.

A raw log row has ``topic0..topic3`` (0x + 64 hex) and ``data`` (0x + 64 hex
per word). For an event signature such as
``Swap(address indexed sender, uint amount0In, ...)`` indexed arguments are
read from topics 1.., the others from consecutive data words (static ABI types
only: address, uint<N>, int<N> (as unsigned words), bool, bytes32).

Output columns follow the extractor's naming: ``event__<name>`` holds the
address (``0x`` + 40 hex) or the hex word; numeric words also get
``event__<name>_f64``. A 256-bit word becomes a double from four 64-bit limbs
(hi to lo): ``((l0 * 2^192 + l1 * 2^128) + l2 * 2^64) + l3``. Precision beyond
2^53 is lost, as in any f64 column; the hex word is kept beside it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Param:
    name: str
    type: str
    indexed: bool


def parse_signature(signature: str) -> tuple[str, list[Param]]:
    """``"Name(type [indexed] name, ...)"`` -> (name, params). Unnamed
    parameters are called ``arg<i>``."""
    m = re.fullmatch(r"\s*(\w+)\s*\((.*)\)\s*", signature)
    if not m:
        raise ValueError(f"not an event signature: {signature!r}")
    params = []
    for i, part in enumerate(p.strip() for p in m.group(2).split(",") if p.strip()):
        toks = part.split()
        indexed = "indexed" in toks
        toks = [t for t in toks if t != "indexed"]
        typ = toks[0]
        name = toks[1] if len(toks) > 1 else f"arg{i}"
        params.append(Param(name, typ, indexed))
    return m.group(1), params


def _hex_body(c: Column) -> Column:
    """Lower-case hex without the 0x prefix."""
    return F.lower(F.regexp_replace(c, r"^0x", ""))


def word_to_double(word: Column) -> Column:
    """64-hex-char word -> double via four 64-bit limbs."""
    acc = None
    for i in range(4):
        limb = F.conv(F.substring(word, 1 + 16 * i, 16), 16, 10).cast("double")
        term = limb * F.lit(float(2 ** (64 * (3 - i))))
        acc = term if acc is None else acc + term
    return acc


def _is_numeric(t: str) -> bool:
    return t.startswith("uint") or t.startswith("int") or t == "bool"


#: hex columns of a raw log
HEX_COLUMNS = ("transaction_hash", "address", "topic0", "topic1", "topic2", "topic3", "data")


def ingest_logs(logs: DataFrame, path: str) -> DataFrame:
    """Write raw logs for selection by event and contract, and read them back.

    All hex is stored in lower case, so that ``decode_logs(..., lower_hex=True)`` compares
    bare columns. Rows are sorted by (topic0, address) within each file: the statistics of
    a row group then span few events, and Bloom filters on both columns rule out the row
    groups whose span holds a value that they do not have. Sorting is local; nothing is
    shuffled."""
    low = {c: F.lower(c) for c in HEX_COLUMNS if c in logs.columns}
    w = logs.withColumns(low).sortWithinPartitions("topic0", "address").write.mode("overwrite")
    for c in ("topic0", "address"):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.option("compression", "zstd").parquet(path)
    return logs.sparkSession.read.schema(logs.schema).parquet(path)


def decode_logs(logs: DataFrame, signature: str, topic0: str | None = None,
                contracts: list[str] | None = None,
                keep: tuple[str, ...] = ("block_number", "transaction_hash", "address"),
                lower_hex: bool = False) -> DataFrame:
    """Select logs of one event (by ``topic0`` and optional contract list) and
    decode its arguments into ``event__*`` columns. With ``lower_hex`` (hex is lower
    case in storage, see ``ingest_logs``) the filters compare bare columns and are pushed
    to the parquet scan; otherwise case does not count."""
    _, params = parse_signature(signature)
    d = logs
    hexed = F.col if lower_hex else (lambda c: F.lower(F.col(c)))
    if topic0 is not None:
        d = d.filter(hexed("topic0") == topic0.lower())
    if contracts:
        d = d.filter(hexed("address").isin([c.lower() for c in contracts]))
    data = _hex_body(F.col("data"))
    cols = [F.col(k) for k in keep]
    ti, wi = 1, 0
    for p in params:
        if p.indexed:
            word = _hex_body(F.col(f"topic{ti}"))
            ti += 1
        else:
            word = F.substring(data, 1 + 64 * wi, 64)
            wi += 1
        out = f"event__{p.name}"
        if p.type == "address":
            cols.append(F.concat(F.lit("0x"), F.substring(word, 25, 40)).alias(out))
        else:
            cols.append(F.concat(F.lit("0x"), word).alias(out))
            if _is_numeric(p.type):
                cols.append(word_to_double(word).alias(out + "_f64"))
    return d.select(*cols)
