"""DuckDB SQL fragments for the oracle queries.

The same helper semantics as ``functions.numeric`` spelled in SQL, plus a CTE
assembler that pulls in the stand-in views a query depends on.
"""

from __future__ import annotations

from chainlens.sources.standins import STANDIN_DEPS, STANDIN_SQL


def ieee(a: str, b: str) -> str:
    """IEEE division (DuckDB double division already yields inf / NaN)."""
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))"


def rnd(x: str, d: int = 0) -> str:
    s = f"{float(10 ** d)!r}"
    return (f"(CASE WHEN isnan(CAST({x} AS DOUBLE)) OR isinf(CAST({x} AS DOUBLE)) THEN CAST({x} AS DOUBLE) "
            f"WHEN ({x}) < 0 THEN -CAST(floor(-({x}) * {s} + 0.5) AS BIGINT) / {s} "
            f"ELSE CAST(floor(({x}) * {s} + 0.5) AS BIGINT) / {s} END)")


def nz(x: str) -> str:
    """fill_nan(0): NaN -> 0, null and inf untouched."""
    return f"(CASE WHEN isnan({x}) THEN 0.0 ELSE {x} END)"


def with_ctes(standins: list[str], ctes: list[tuple[str, str]], body: str) -> str:
    need: list[str] = []

    def add(n: str) -> None:
        for d in STANDIN_DEPS.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in standins:
        add(n)
    parts = [f"{n} AS ({STANDIN_SQL[n]}\n)" for n in need]
    parts += [f"{n} AS (\n{s}\n)" for n, s in ctes]
    recursive = any(f" {n} " in f" {b} " or f"FROM {n} " in b for n, b in ctes)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


def esum(x: str) -> str:
    """Sum of finite values as decimals of 12 places (matches ``exact_sum``)."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,12))) AS DOUBLE)"


def emean(x: str) -> str:
    return f"({esum(x)} / count({x}))"


def omean(x: str) -> str:
    lst = f"list_sort(list(CAST({x} AS DOUBLE)) FILTER (WHERE ({x}) IS NOT NULL))"
    return (f"(CASE WHEN len({lst}) > 0 THEN "
            f"list_reduce(list_prepend(0.0, {lst}), lambda a, b: a + b) / len({lst}) END)")
