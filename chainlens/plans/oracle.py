"""DuckDB oracle SQL for every registered query.

Each string runs on the driver's raw tables (pre-registered views) and
rebuilds the stand-in views inline, so it checks the whole chain
(stand-ins -> enrichment -> query). Column names equal the Spark outputs.
"""

from __future__ import annotations

from chainlens.constants import ROLLING_WINDOWS, SEQUENCER_NAMES
from chainlens.plans.sqlparts import emean, esum, ieee, nz, omean, rnd, with_ctes

TX_COLS = [
    "block_number", "transaction_index", "transaction_hash", "from_address", "gas_used",
    "n_input_bytes", "n_input_zero_bytes", "n_input_nonzero_bytes", "n_rlp_bytes",
    "block_batch",
]


def q1_ctes(mempool: bool = False, windows=None, name: str = "q1") -> list[tuple[str, str]]:
    windows = dict(ROLLING_WINDOWS if windows is None else windows)
    tcols = ", ".join(f"t.{c}" for c in TX_COLS)
    mcols = ", m.seen_at" if mempool else ""
    mjoin = " LEFT JOIN mempool m ON t.transaction_hash = m.hash" if mempool else ""
    j = f"""
SELECT {tcols}, t.gas_price, t.max_priority_fee_per_gas, t.max_fee_per_gas{mcols},
       b.timestamp, b.base_fee_per_gas, b.gas_used AS gas_used_block
FROM transactions t{mjoin}
LEFT JOIN blocks b ON t.block_batch = b.block_batch AND t.block_number = b.block_number"""
    order = "block_number, transaction_index" + (", seen_at NULLS FIRST" if mempool else "")
    wins, defs = [], ["pb AS (PARTITION BY block_batch, block_number)"]
    for k, n in windows.items():
        defs.append(f"r_{k} AS (PARTITION BY block_batch ORDER BY {order} "
                    f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
        wins.append(f"CASE WHEN count(base_fee_per_gas) OVER r_{k} = {n} "
                    f"THEN CAST(sum(base_fee_per_gas) OVER r_{k} AS DOUBLE) / {float(n)!r} "
                    f"END AS avg_base_fee_{k}")
    w = f"""
SELECT *,
  max(transaction_index) OVER pb AS transaction_index_max,
  CAST(sum(n_rlp_bytes) OVER pb AS BIGINT) AS block_encoded_bytes,
  CAST(sum(n_input_bytes) OVER pb AS BIGINT) AS block_calldata_bytes{''.join(', ' + x for x in wins)}
FROM {name}_j
WINDOW {', '.join(defs)}"""
    keep = TX_COLS + (["seen_at"] if mempool else []) + ["timestamp", "gas_used_block",
                                                         "transaction_index_max"]
    avg_cols = [f"avg_base_fee_{k}" for k in windows]
    c = f"""
SELECT {', '.join(keep)},
  CAST(gas_used AS DOUBLE) * gas_price / 1e18 AS tx_gas_cost,
  make_timestamp(timestamp * 1000000) AS block_datetime,
  {ieee('gas_price', 'base_fee_per_gas')} AS block_gas_premium,
  {', '.join(avg_cols) + ',' if avg_cols else ''}
  {ieee('transaction_index', 'transaction_index_max')} * 100 AS blockspace_percentile,
  gas_price / 1e9 AS gas_price_gwei,
  max_priority_fee_per_gas / 1e9 AS max_priority_fee_per_gas_gwei,
  max_fee_per_gas / 1e9 AS max_fee_per_gas_gwei,
  base_fee_per_gas / 1e9 AS base_fee_per_gas_gwei,
  {''.join(f'{a} / 1e9 AS {a}_gwei, ' for a in avg_cols)}
  block_encoded_bytes / 1e3 AS block_encoded_kbytes,
  block_calldata_bytes / 1e3 AS block_calldata_kbytes
FROM {name}_w"""
    dbl = (["tx_gas_cost", "block_gas_premium"] + avg_cols + ["blockspace_percentile"]
           + ["gas_price_gwei", "max_priority_fee_per_gas_gwei", "max_fee_per_gas_gwei",
              "base_fee_per_gas_gwei"] + [f"{a}_gwei" for a in avg_cols]
           + ["block_encoded_kbytes", "block_calldata_kbytes"])
    other = keep + ["block_datetime"]
    f = f"""
SELECT DISTINCT {', '.join(other)},
  {', '.join(f'{nz(x)} AS {x}' for x in dbl)},
  {nz(rnd('blockspace_percentile', 0))} AS rounded_blockspace_percentile
FROM {name}_c"""
    return [(f"{name}_j", j), (f"{name}_w", w), (f"{name}_c", c), (name, f)]


def q3_ctes(windows=None) -> list[tuple[str, str]]:
    body = """
SELECT q1.* EXCLUDE (timestamp), l.sequencer_names
FROM q1 JOIN sequencer_labels l ON q1.from_address = l.sequencer_addresses"""
    return q1_ctes(windows=windows) + [("q3", body)]


ROLLUP_STANDINS = ["transactions", "blocks", "sequencer_labels"]


def _enrich_oracle(out: dict[str, str]) -> None:
    out["extend_txs_blocks"] = with_ctes(["transactions", "blocks"], q1_ctes(),
                                         "SELECT * FROM q1")
    out["extend_txs_blocks_mempool"] = with_ctes(
        ["transactions", "blocks", "mempool"], q1_ctes(mempool=True), "SELECT * FROM q1")
    out["label_rollups"] = with_ctes(ROLLUP_STANDINS, q3_ctes(), "SELECT * FROM q3")


# --- rollup dashboard (Q4-Q17) ------------------------------------------------

def q4_ctes(since: str, windows=None) -> list[tuple[str, str]]:
    windows = list((ROLLING_WINDOWS if windows is None else windows))
    avg = ", ".join(f"avg_base_fee_{k} * gas_used / 1e18 AS tx_gas_cost_avg_{k}" for k in windows)
    dl = ", ".join(f"tx_gas_cost - tx_gas_cost_avg_{k} AS tx_gas_cost_delta_{k}" for k in windows)
    return q3_ctes() + [
        ("q4a", f"SELECT *, {avg} FROM q3 WHERE block_datetime >= TIMESTAMP '{since}'"),
        ("q4", f"SELECT *, {dl} FROM q4a"),
    ]


def _pivot_cols(value: str, names, agg: str = "max", default: str = "0.0", wrap=None) -> str:
    out = []
    for n in names:
        e = f"coalesce({agg}({value}) FILTER (WHERE sequencer_names = '{n}'), {default})"
        out.append(f"{wrap(e) if wrap else e} AS {n}")
    return ", ".join(out)


def daily_pivot_ctes(per_bs_sql: str, names, name: str) -> list[tuple[str, str]]:
    return [
        (f"{name}_bs", per_bs_sql),
        (f"{name}_ts", f"""
SELECT CAST(block_datetime AS DATE) AS d, block_datetime, sequencer_names, {emean('v')} AS v
FROM {name}_bs GROUP BY ALL"""),
        (f"{name}_day", f"SELECT d, sequencer_names, {esum('v')} AS v FROM {name}_ts GROUP BY ALL"),
        (name, f"""
SELECT d AS block_datetime, {_pivot_cols('v', names, wrap=lambda e: rnd(e, 2))}
FROM {name}_day GROUP BY d"""),
    ]


def tx_cost_avg_ctes(col: str, names, name: str) -> list[tuple[str, str]]:
    return daily_pivot_ctes(f"""
SELECT block_number, sequencer_names, max(block_datetime) AS block_datetime,
       coalesce({esum(col)}, 0.0) AS v
FROM q4 GROUP BY block_number, sequencer_names""", names, name)


def calldata_ctes(col: str, names, name: str) -> list[tuple[str, str]]:
    agg = {
        "sequencer_total_mbytes": "coalesce(sum(n_input_bytes), 0) / 1e6",
        "sequencer_mb_gas_ratio": emean(f"{ieee('n_input_bytes', 'gas_price_gwei')} / 1e6"),
        "calldata_mb_block_gas_ratio": emean(f"{ieee('block_calldata_kbytes', 'gas_price_gwei')} / 1e3"),
    }[col]
    return daily_pivot_ctes(f"""
SELECT block_number, sequencer_names, max(block_datetime) AS block_datetime, {agg} AS v
FROM q4 GROUP BY block_number, sequencer_names""", names, name)


def monthly_sql(daily: str, sequencers) -> list[tuple[str, str]]:
    means = ", ".join(
        f"CAST(sum(CAST(round({s} * 100) AS BIGINT)) AS DOUBLE) / count({s}) / 100.0 AS {s}"
        for s in sequencers)
    return [
        ("m_d", f"SELECT CAST(date_trunc('month', block_datetime) AS DATE) AS block_month, * FROM {daily}"),
        ("m_mean", f"SELECT block_month, {means} FROM m_d GROUP BY block_month"),
        ("m_months", """
SELECT CAST(unnest(generate_series(min(block_month), max(block_month), INTERVAL 1 MONTH)) AS DATE)
       AS block_month FROM m_d"""),
        ("monthly", f"""
SELECT mm.block_month, strftime(mm.block_month, '%b %Y') AS month_label,
       {', '.join('mean.' + s + ' AS ' + s for s in sequencers)}
FROM m_months mm LEFT JOIN m_mean mean ON mm.block_month = mean.block_month"""),
    ]


def blob_non_agg_sql(names) -> list[tuple[str, str]]:
    cols = ", ".join(f"CAST(coalesce(sum(s) FILTER (WHERE sequencer_names = '{n}'), 0) AS BIGINT) AS {n}"
                     for n in names)
    return [
        ("bna_bs", """
SELECT block_number, sequencer_names, CAST(ceil(sum(n_input_bytes) / 128000.0) AS BIGINT) AS s
FROM q4 GROUP BY block_number, sequencer_names"""),
        ("blob_non_agg", f"SELECT block_number, {cols}, CAST(sum(s) AS BIGINT) AS blob_count "
                         "FROM bna_bs GROUP BY block_number"),
    ]


BLOB_AGG_SQL = ("blob_agg", """
SELECT block_number, max(block_datetime) AS block_datetime,
       CAST(coalesce(sum(n_input_bytes), 0) AS BIGINT) AS sequencer_total_bytes,
       CAST(ceil(coalesce(sum(n_input_bytes), 0) / 128000.0) AS BIGINT) AS blob_count
FROM q4 GROUP BY block_number""")


def blob_series_sql(counts: str, since: str, name: str) -> tuple[str, str]:
    return (name, f"""
SELECT b.block_number, CAST(coalesce(c.blob_count, 0) AS BIGINT) AS blob_count,
       make_timestamp(b.timestamp * 1000000) AS datetime
FROM blocks b LEFT JOIN {counts} c ON b.block_number = c.block_number
WHERE b.timestamp >= CAST(epoch(TIMESTAMP '{since}') AS BIGINT)""")


def q15_sql(windows=None) -> str:
    windows = list((ROLLING_WINDOWS if windows is None else windows))
    avg_bs = ", ".join(f"coalesce({esum('tx_gas_cost_avg_' + k)}, 0) AS avg_{k}" for k in windows)
    avg_seq = ", ".join(f"{rnd(esum(f'avg_{k}'), 2)} AS tx_cost_{k}_delta_eth" for k in windows)
    return f"""
, s_bs AS (
SELECT block_number, sequencer_names, count(*) AS n, coalesce({esum('tx_gas_cost')}, 0) AS cost,
       coalesce(sum(n_input_bytes), 0) AS inb, coalesce(sum(n_rlp_bytes), 0) AS rlp, {avg_bs}
FROM q4 GROUP BY block_number, sequencer_names),
s_seq AS (
SELECT sequencer_names, CAST(count(*) AS DOUBLE) AS n_blocks, CAST(sum(n) AS DOUBLE) AS n_txs,
       {rnd(esum('cost'), 2)} AS tota_cost_eth, {rnd('sum(inb) / 1e6', 2)} AS total_mbytes,
       {rnd('sum(rlp) / 1e6', 2)} AS rlp_mb, {avg_seq}
FROM s_bs GROUP BY sequencer_names)
SELECT sequencer_names AS sequencer, n_blocks, n_txs, tota_cost_eth,
       {rnd(ieee('rlp_mb', 'tota_cost_eth'), 2)} AS mb_per_eth, total_mbytes,
       {', '.join(f'tx_cost_{k}_delta_eth' for k in windows)}
FROM s_seq"""


def histogram_sql(src: str, x: str, bins: int, by: str | None = None,
                  view: tuple[float, float] | None = None) -> str:
    w = f"((hi - lo) / {float(bins)!r})"
    byc = f"{by}, " if by else ""
    vf = f" WHERE bin_hi >= {float(view[0])!r} AND bin_lo <= {float(view[1])!r}" if view else ""
    return f"""
, h_f AS (SELECT * FROM {src} WHERE {x} IS NOT NULL AND NOT isnan({x})),
h_b AS (SELECT min({x}) AS lo, max({x}) AS hi FROM h_f),
h_c AS (
SELECT {byc}CAST(CASE WHEN {w} > 0 THEN least(floor(({x} - lo) / {w}), {bins - 1}) ELSE 0 END AS BIGINT) AS bin,
       count(*) AS n, any_value(lo) AS lo, any_value({w}) AS w
FROM h_f, h_b GROUP BY ALL),
h_o AS (SELECT {byc}bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, n FROM h_c)
SELECT * FROM h_o{vf}"""


SINCE = "1996-01-01"
NAMES = list(SEQUENCER_NAMES)


def _rollup_oracle(out: dict[str, str]) -> None:
    q4 = q4_ctes(SINCE)
    R = ROLLUP_STANDINS
    out["tx_cost_deltas"] = with_ctes(R, q4, "SELECT * FROM q4")
    out["summarize_dataset"] = with_ctes(R, q4, """
SELECT min(block_number) AS first_block, max(block_number) AS last_block,
       max(block_number) - min(block_number) AS block_range,
       count(DISTINCT block_number) AS n_blocks, count(*) AS n_txs,
       arg_min(block_datetime, block_number) AS first_block_datetime,
       arg_max(block_datetime, block_number) AS last_block_datetime
FROM q4""")
    out["summary_text"] = with_ctes(R, q4, """
SELECT 'block range: ' || format('{:,}', min(block_number)) || ' to ' || format('{:,}', max(block_number))
         || ' = ' || format('{:,}', max(block_number) - min(block_number)) || ' range' AS block_range_info,
       'blocks in dataset: ' || format('{:,}', count(DISTINCT block_number)) || ', total txs: '
         || format('{:,}', count(*)) AS blocks_dataset_info,
       'block date range: ' || CAST(arg_min(block_datetime, block_number) AS VARCHAR) || ' to '
         || CAST(arg_max(block_datetime, block_number) AS VARCHAR) AS block_date_range_info
FROM q4""")
    out["sequencer_list"] = with_ctes(R, q4, "SELECT DISTINCT sequencer_names FROM q4")
    for k in ROLLING_WINDOWS:
        out[f"tx_cost_avg_{k}"] = with_ctes(
            R, q4 + tx_cost_avg_ctes(f"tx_gas_cost_delta_{k}", NAMES, "p"), "SELECT * FROM p")
    out["calldata_posted_mb"] = with_ctes(
        R, q4 + calldata_ctes("sequencer_total_mbytes", NAMES, "p"), "SELECT * FROM p")
    out["calldata_gas_ratio"] = with_ctes(
        R, q4 + calldata_ctes("sequencer_mb_gas_ratio", NAMES, "p"), "SELECT * FROM p")
    out["monthly_chart_series"] = with_ctes(
        R, q4 + calldata_ctes("sequencer_total_mbytes", NAMES, "p") + monthly_sql("p", NAMES),
        "SELECT * FROM monthly")
    out["calldata_cost_per_block"] = with_ctes(R, q4, f"""
SELECT block_number, max(block_datetime) AS block_datetime, sequencer_names,
       {omean(ieee('block_calldata_kbytes', 'gas_price_gwei'))} AS calldata_block_gas_ratio,
       max(block_calldata_kbytes) AS block_calldata_kbytes,
       arg_min(gas_price_gwei, transaction_index) AS gas_price_gwei
FROM q4 GROUP BY block_number, sequencer_names""")
    out["blob_market_per_sequencer"] = with_ctes(R, q4, f"""
SELECT block_number, max(block_datetime) AS block_datetime, max(sequencer_names) AS sequencer_names,
       CAST(coalesce(sum(n_input_bytes), 0) AS BIGINT) AS sequencer_total_bytes,
       CAST(ceil(coalesce(sum(n_input_bytes), 0) / 128000.0) AS BIGINT) AS blob_size_split
FROM q4 WHERE sequencer_names = '{NAMES[0]}' GROUP BY block_number""")
    na = blob_non_agg_sql(NAMES)
    out["blob_market_non_agg"] = with_ctes(R, q4 + na, "SELECT * FROM blob_non_agg")
    out["blob_market_agg"] = with_ctes(R, q4 + [BLOB_AGG_SQL], "SELECT * FROM blob_agg")
    s_na = blob_series_sql("blob_non_agg", SINCE, "series_non_agg")
    s_ag = blob_series_sql("blob_agg", SINCE, "series_agg")
    out["blob_series_non_agg"] = with_ctes(R, q4 + na + [s_na], "SELECT * FROM series_non_agg")
    out["blob_series_agg"] = with_ctes(R, q4 + [BLOB_AGG_SQL, s_ag], "SELECT * FROM series_agg")
    out["blob_demand_buckets"] = _with_tail(R, q4 + na + [BLOB_AGG_SQL, s_na, s_ag], """
, u AS (SELECT 'non_agg' AS market, blob_count FROM series_non_agg
        UNION ALL SELECT 'agg' AS market, blob_count FROM series_agg)
SELECT market, count(*) FILTER (WHERE blob_count = 0) AS zero_blobs,
       count(*) FILTER (WHERE blob_count > 0 AND blob_count <= 3) AS one_to_three_blobs,
       count(*) FILTER (WHERE blob_count > 3) AS more_than_3_blobs,
       count(*) FILTER (WHERE blob_count > 6) AS more_than_6_blobs
FROM u GROUP BY market""")
    out["agg_sequencer_stats"] = _with_tail(R, q4, q15_sql())
    gas = ("g", f"""
SELECT block_number, sequencer_names,
       {rnd('CAST(coalesce(sum(gas_used), 0) AS DOUBLE)', 0)} AS sequencer_gas_used_sum,
       count(*) AS n_txs
FROM q4 GROUP BY block_number, sequencer_names""")
    gf = ("gf", "SELECT * FROM g WHERE sequencer_gas_used_sum < 1e8")
    out["sequencer_gas_histogram"] = _with_tail(
        R, q4 + [gas, gf], histogram_sql("gf", "sequencer_gas_used_sum", 50, "sequencer_names"))
    share = f"""
SELECT block_number, sequencer_names,
       {ieee('coalesce(sum(gas_used), 0)', 'max(gas_used_block)')} AS sequencer_gas_used_pct,
       max(gas_used_block) AS total_gas_in_block
FROM q4 GROUP BY block_number, sequencer_names"""
    out["sequencer_gas_share"] = with_ctes(R, q4, share)
    out["sequencer_gas_share_top"] = with_ctes(R, q4, f"""
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY sequencer_gas_used_pct DESC NULLS FIRST,
                                            block_number, sequencer_names) AS rank
               FROM ({share})) WHERE rank <= {TOP}""")


def _with_tail(standins, ctes, tail: str) -> str:
    """``tail`` starts with more CTEs (``, name AS (...) ... SELECT``)."""
    return with_ctes(standins, ctes, tail)


# --- volatility, moments, Kalman (Q18-Q23) ------------------------------------

VOL_N = 300
TAIL = 500
TOP = 100
DEC = 6


def q18_ctes(n: int = VOL_N) -> list[tuple[str, str]]:
    return [("q18", f"""
SELECT *, base_fee_per_gas / 1e9 AS base_fee_per_gas_gwei,
       base_fee_per_gas / 1e9 - lag(base_fee_per_gas / 1e9, {n}) OVER (ORDER BY block_number)
         AS base_fee_per_gas_gwei_diff,
       gas_used - lag(gas_used, {n}) OVER (ORDER BY block_number) AS gas_used_diff
FROM block_series""")]


def _kstep(p: str, q: str, r: str) -> str:
    """Gain for predicted covariance ``p`` (guarded like the Python filter)."""
    return f"(CASE WHEN ({p}) + {r} <> 0 THEN ({p}) / (({p}) + {r}) ELSE 1.0 END)"


def q21_ctes(dec: int = DEC) -> list[tuple[str, str]]:
    lagw = "OVER (PARTITION BY series ORDER BY rn)"
    vs = {"g": "gas_used", "f": "base_fee_per_gas"}
    lag_cols = ", ".join(
        f"CAST({c} AS DOUBLE) - lag({c}, 1) {lagw} AS d{k}, "
        f"CAST(lag({c}, 1) {lagw} AS DOUBLE) - lag({c}, 2) {lagw} AS dp{k}"
        for k, c in vs.items())
    prm = ", ".join(
        f"greatest(-coalesce(covar_pop(d{k}, dp{k}), 0.0), 0.0) AS r{k}, "
        f"greatest(coalesce(var_pop(d{k}), 0.0) - 2 * greatest(-coalesce(covar_pop(d{k}, dp{k}), 0.0), 0.0), 0.0) AS q{k}"
        for k in vs)
    first = ", ".join(
        f"CAST(s.{c} AS DOUBLE) AS x{k}, (1.0 - {_kstep('1.0', 'q' + k, 'p.r' + k)}) * 1.0 AS p{k}"
        for k, c in vs.items())
    step = ", ".join(
        f"r.x{k} + {_kstep(f'r.p{k} + p.q{k}', 'p.q' + k, 'p.r' + k)} * (CAST(s.{c} AS DOUBLE) - r.x{k}) AS x{k}, "
        f"(1.0 - {_kstep(f'r.p{k} + p.q{k}', 'p.q' + k, 'p.r' + k)}) * (r.p{k} + p.q{k}) AS p{k}"
        for k, c in vs.items())
    return [
        ("k_smp", """
SELECT series, block_number, gas_used, base_fee_per_gas,
       row_number() OVER (PARTITION BY series ORDER BY block_number) AS rn
FROM block_series"""),
        ("k_lag", f"SELECT series, rn, {lag_cols} FROM k_smp"),
        ("k_prm", f"SELECT series, {prm} FROM k_lag GROUP BY series"),
        ("k_rec", f"""
SELECT s.series, s.rn, {first}
FROM k_smp s JOIN k_prm p ON s.series = p.series WHERE s.rn = 1
UNION ALL
SELECT r.series, r.rn + 1, {step}
FROM k_rec r JOIN k_smp s ON s.series = r.series AND s.rn = r.rn + 1
             JOIN k_prm p ON p.series = r.series"""),
        ("q21", f"""
SELECT s.series, s.block_number, {rnd('k.xg', dec)} AS gas_used_kalman,
       {rnd('k.xf / 1e9', dec)} AS base_fee_per_gas_kalman, s.gas_used,
       s.base_fee_per_gas / 1e9 AS base_fee_per_gas,
       {rnd('k.xf / 1e9 - s.base_fee_per_gas / 1e9', dec)} AS base_fee_per_gas_diff
FROM k_smp s JOIN k_rec k ON s.series = k.series AND s.rn = k.rn"""),
    ]


def _vol_oracle(out: dict[str, str]) -> None:
    B = ["block_series"]
    q18 = q18_ctes()
    out["block_volatility"] = with_ctes(B, q18, "SELECT * FROM q18")
    out["volatility_moments"] = with_ctes(B, q18 + [
        ("m_x", "SELECT coalesce(base_fee_per_gas_gwei_diff, 0.0) AS x FROM q18"),
        ("m_mu", "SELECT avg(x) AS mu FROM m_x"),
        ("m_c", "SELECT avg(power(x - mu, 2)) AS m2, avg(power(x - mu, 3)) AS m3 FROM m_x, m_mu")],
        f"""
SELECT {rnd('(SELECT avg(x) FROM m_x)', DEC)} AS mean,
       {rnd('(SELECT var_pop(x) FROM m_x)', DEC)} AS variance,
       {rnd('(SELECT m3 / power(m2, 1.5) FROM m_c)', DEC)} AS skewness,
       {rnd('(SELECT kurtosis_pop(x) FROM m_x)', DEC)} AS kurtosis""")
    g1 = "(SELECT m3 / power(m2, 1.5) FROM z_c)"
    g2 = "(SELECT kurtosis_pop(base_fee_per_gas_gwei) FROM q18)"
    n = "(SELECT CAST(count(base_fee_per_gas_gwei) AS DOUBLE) FROM q18)"
    out["fee_zscore_kurtosis"] = with_ctes(B, q18 + [
        ("z_m", "SELECT avg(base_fee_per_gas_gwei) AS mu, stddev_pop(base_fee_per_gas_gwei) AS sd FROM q18"),
        ("z_c", "SELECT avg(power(base_fee_per_gas_gwei - mu, 2)) AS m2, "
                "avg(power(base_fee_per_gas_gwei - mu, 3)) AS m3 FROM q18, z_m")],
        f"""
SELECT {rnd('(SELECT kurtosis_pop((base_fee_per_gas_gwei - mu) / sd) FROM q18, z_m)', DEC)} AS zscore_kurtosis,
       {rnd(f'({n} - 1) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * {g2} + 6)', DEC)} AS kurt,
       {rnd(f'{g1} * sqrt({n} * ({n} - 1)) / ({n} - 2)', DEC)} AS skew""")
    out["fee_zscore"] = with_ctes(B, [
        ("z_s", "SELECT *, base_fee_per_gas / 1e9 AS base_fee_per_gas_gwei FROM block_series"),
        ("z_m", "SELECT avg(base_fee_per_gas_gwei) AS mu, stddev_pop(base_fee_per_gas_gwei) AS sd FROM z_s")],
        f"SELECT z_s.*, {rnd('(base_fee_per_gas_gwei - mu) / sd', DEC)} AS zscore FROM z_s, z_m")
    q21 = q21_ctes()
    out["kalman_fee_filter"] = with_ctes(B, q21, "SELECT * FROM q21")
    s = 1e6

    def tot(e: str) -> str:
        return f"coalesce(CAST(sum(CAST(round({e} * {s!r}) AS BIGINT)) AS DOUBLE) / {s!r}, 0.0)"

    d = "base_fee_per_gas_diff"
    out["kalman_error_sums"] = with_ctes(B, q21, f"""
SELECT series, {tot(d)} AS diff_sum,
       {tot(f'CASE WHEN {d} > 0 THEN {d} END')} AS diff_pos_sum,
       {tot(f'CASE WHEN {d} < 0 THEN {d} END')} AS diff_neg_sum
FROM q21 GROUP BY series""")
    out["kalman_tail_sample"] = with_ctes(B, [], f"""
SELECT series, block_number, gas_used, base_fee_per_gas, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY block_number)
            - greatest(count(*) OVER (PARTITION BY series) - {TAIL}, 0) AS rn FROM block_series) WHERE rn > 0""")
    out["kalman_diff_histogram"] = _with_tail(B, q21, histogram_sql("q21", d, 10, "series"))
    out["volatility_diff_histogram"] = _with_tail(
        B, q18, histogram_sql("q18", "base_fee_per_gas_gwei_diff", 1000, None))


# --- swaps (Q24-Q27) ----------------------------------------------------------

Q24_SQL = ("q24", """
SELECT block_number, transaction_hash AS swaps_transaction_id, address AS swaps_pool_id,
       event__to AS swaps_recipient, event__sender AS swaps_sender,
       CASE WHEN event__amount0In_f64 > 0 THEN event__amount0In_f64 ELSE event__amount0Out_f64 * -1 END
         AS swaps_amount0,
       CASE WHEN event__amount1In_f64 > 0 THEN event__amount1In_f64 ELSE event__amount1Out_f64 * -1 END
         AS swaps_amount1
FROM univ2_swaps""")


def _swap_oracle(out: dict[str, str]) -> None:
    from chainlens.constants import PAIR_CREATED_TOPIC0, SWAP_TOPIC0, UNIV2_FACTORY
    from chainlens.sources.standins import raw_pair_logs_sql

    def amount(k: int, name: str) -> str:
        # the stand-in amounts fit the low 8 bytes of their 32-byte word
        word = f"substr(data, {3 + 64 * k}, 64)"
        return (f"'0x' || {word} AS event__{name}, "
                f"CAST(('0x' || right({word}, 16))::UBIGINT AS DOUBLE) AS event__{name}_f64")

    out["swap_net_amounts"] = with_ctes(["univ2_swaps"], [Q24_SQL], "SELECT * FROM q24")
    out["swaps_enriched"] = with_ctes(["univ2_swaps", "univ2_pools", "univ2_tokens"], [Q24_SQL], """
SELECT q.*, p.event__token0, p.event__token1,
       t0.name, t0.symbol, t0.decimals,
       t1.name AS name_token1, t1.symbol AS symbol_token1, t1.decimals AS decimals_token1
FROM q24 q
LEFT JOIN univ2_pools p ON q.swaps_pool_id = p.event__pair
LEFT JOIN univ2_tokens t0 ON p.event__token0 = t0.erc20
LEFT JOIN univ2_tokens t1 ON p.event__token1 = t1.erc20""")
    out["pool_token_list"] = with_ctes(["univ2_pools"], [], """
SELECT event__token0 AS token FROM univ2_pools
UNION SELECT event__token1 AS token FROM univ2_pools""")
    out["decode_swap_logs"] = with_ctes(
        ["raw_swap_logs"], [], f"""
SELECT block_number, transaction_hash, address,
       '0x' || right(topic1, 40) AS event__sender, '0x' || right(topic2, 40) AS event__to,
       {amount(0, 'amount0In')}, {amount(1, 'amount1In')}, {amount(2, 'amount0Out')}, {amount(3, 'amount1Out')}
FROM raw_swap_logs WHERE lower(topic0) = '{SWAP_TOPIC0}'""")
    out["decode_pair_logs"] = with_ctes(
        [], [("raw_pair_logs", raw_pair_logs_sql(UNIV2_FACTORY))],
        f"""
SELECT block_number, transaction_hash, lower(address) AS address,
       '0x' || right(topic1, 40) AS event__token0, '0x' || right(topic2, 40) AS event__token1,
       '0x' || substr(data, 27, 40) AS event__pair, {amount(1, 'arg3')}
FROM raw_pair_logs WHERE lower(topic0) = '{PAIR_CREATED_TOPIC0}' AND lower(address) = lower('{UNIV2_FACTORY}')""")


# --- jobs and streams (Q28-Q31) ------------------------------------------------

def _job_oracle(out: dict[str, str]) -> None:
    from chainlens.sources.standins import BLOCKS_PER_BATCH as B

    def files(src: str, ds: str) -> str:
        return (f"SELECT printf('{ds}__%08d_to_%08d.parquet', block_batch * {B}, "
                f"block_batch * {B} + {B - 1}) AS file_name FROM (SELECT DISTINCT block_batch FROM {src})")

    def per(src: str, ds: str, side: str) -> str:
        return (f"SELECT CAST(regexp_extract(file_name, 'to_(\\d+)', 1) AS BIGINT) AS batch_end, "
                f"string_agg(file_name, ',' ORDER BY file_name) AS files_{side} "
                f"FROM ({files(src, ds)}) GROUP BY 1")

    out["sync_batches"] = with_ctes(["transactions", "blocks"], [
        ("fa", per("transactions", "ethereum__transactions", "a")),
        ("fb", per("blocks", "ethereum__blocks", "b"))],
        "SELECT fa.batch_end, files_a, files_b FROM fa JOIN fb ON fa.batch_end = fb.batch_end")
    out["list_batch_files"] = with_ctes(["blocks"], [("lf", files("blocks", "ethereum__blocks"))], """
SELECT file_name, CAST(regexp_extract(file_name, 'to_([0-9]+)', 1) AS BIGINT) AS batch_end,
       regexp_extract(file_name, '__([0-9]+_to_[0-9]+)', 1) AS batch_range FROM lf""")
    cols = "block_number, timestamp, base_fee_per_gas, gas_used, block_batch"
    out["select_blocks"] = with_ctes(["blocks"], [], f"""
SELECT {cols}, 'range' AS selection FROM blocks WHERE block_number BETWEEN 500 AND 1499
UNION ALL SELECT {cols}, 'latest' FROM blocks WHERE block_number = (SELECT max(block_number) FROM blocks)""")
    out["copy_batches"] = with_ctes(["blocks"], [], f"SELECT {cols} FROM blocks")
    out["write_rollups_incremental"] = out["label_rollups"]
    out["write_rollups_stream"] = out["label_rollups"]
    out["combine_files"] = with_ctes(["univ2_swaps"], [], "SELECT * FROM univ2_swaps")
    out["daily_totals_stream"] = with_ctes(ROLLUP_STANDINS, q3_ctes(), """
SELECT CAST(block_datetime AS DATE) AS day, sequencer_names, count(*) AS n_txs,
       CAST(sum(gas_used) AS BIGINT) AS gas_used, CAST(sum(n_input_bytes) AS BIGINT) AS n_input_bytes
FROM q3 GROUP BY 1, 2""")


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    _enrich_oracle(out)
    _rollup_oracle(out)
    _vol_oracle(out)
    _swap_oracle(out)
    _job_oracle(out)
    return out
