"""Fixed values that must equal the surveyed library's for equal results."""

# --- fixed values -----------------------------------------------------------
# Rollup sequencer submitter addresses and their names, in the given order.
SEQUENCER_ADDRESSES = [
    "0xc1b634853cb333d3ad8663715b08f41a3aec47cc",
    "0x6887246668a3b87f54deb3b94ba47a6f63f32985",
    "0x9228624c3185fcbcf24c1c9db76d8bef5f5dad64",
    "0x6667961f5e9c98a76a48767522150889703ed77d",
    "0xcf2898225ed05be911d3709d9417e86e0b4cfc8f",
    "0x148ee7daf16574cd020afa34cc658f8f3fbd2800",
    "0x16d5783a96ab20c9157d7933ac236646b29589a4",
    "0x5050f69a9786f081509234f1a7f4684b5e5b76c9",
]
SEQUENCER_NAMES = [
    "arbitrum",
    "optimism",
    "linea",
    "mantle",
    "scroll",
    "polygon_zkevm",
    "starknet",
    "base",
]

# Rolling base-fee windows, in transaction rows.
ROLLING_WINDOWS = {"daily": 7200, "hourly": 300, "minute": 5}

# Blob size in bytes; blobs are counted as ceil(bytes / BLOB_BYTES).
BLOB_BYTES = 128000

# Dashboard start date.
DEFAULT_SINCE = "2023-01-01"

# Event signatures and their topic0 hashes.
SWAP_SIGNATURE = (
    "Swap(address indexed sender, uint amount0In, uint amount1In, "
    "uint amount0Out, uint amount1Out, address indexed to)"
)
SWAP_TOPIC0 = "0xd78ad95fa46c994b6551d0da85fc275fe613ce37657fb8d5e3d130840159d822"
PAIR_CREATED_SIGNATURE = (
    "PairCreated(address indexed token0, address indexed token1, address pair, uint)"
)
PAIR_CREATED_TOPIC0 = "0x0d3648bd0f6ba80134a33ba9275ac585d9d315f0ad8355cddefde31afa28d0e9"
# Uniswap V2 factory contract that emits PairCreated.
UNIV2_FACTORY = "0x5c69bee701ef814a2b6a3edd4b1652cb9cc5aa6f"

# File-name patterns carrying the block batch.
BATCH_END_PATTERN = r"to_(\d+)"
BATCH_RANGE_PATTERN = r"__(\d+_to_\d+)"
# ---------------------------------------------------------------------------

WEI_PER_GWEI = 1e9
WEI_PER_ETH = 1e18
