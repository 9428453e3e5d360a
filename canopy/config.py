"""Fixed values of the telemetry pipeline.

These are the behavioural constants the results depend on. They are stated
once, here, in plain form; every operator takes them as overridable
parameters.
"""

from __future__ import annotations

# --- fixed values (must equal the original pipeline's for equal results) ---
ROLLING_WINDOW_DAYS = 30          # retention horizon and first-run lookback
TIMESTAMP_BUFFER_SECONDS = 10     # restart buffer after the high-water mark
FRESHNESS_HOURS = 24              # a point is fresh if run within this many hours
CATEGORIES = ["type1", "type2", "less50", "between50and100", "other"]
ALIGNED_CATEGORIES = ["type1", "type2"]                  # inner alignment
RAGGED_CATEGORIES = ["less50", "between50and100", "other"]  # full outer alignment
PAGE_LIMIT_DEFAULT = 100
PAGE_LIMIT_MAX = 10_000
ID_LIMIT_DEFAULT = 100
ID_LIMIT_MAX = 1_000
NUMERIC_TYPE_FAMILY = ["int", "bigint", "float", "double", "decimal"]
METADATA_TABLE = "staging_metadata"
# --- end of fixed values ---

# Our own naming for stored wide tables (the inventory patterns follow it).
WIDE_TABLE_PREFIX = "wide_"

# Engineering knobs (not semantics).
# Largest number of rows one window task numbers before a point is split into
# time buckets (see operators.sequence).
MAX_ROWS_PER_SEQUENCE_TASK = 8_000_000
# Largest small side (bytes) we broadcast when its row count is known, and what
# a point name or other text in it is counted as.
MAX_BROADCAST_BYTES = 64 << 20
NAME_BYTES = 256
# Up to this many points a wide table's checks are per-point counts inside the
# pivot; beyond it they run before the pivot on the rows of one id (generated
# code for a per-row expression over thousands of columns exceeds the JVM
# method limit). Both give the same rows.
WIDE_BLOCK_POINTS = 64
# Ids per block of a wide table that is kept up to date (sources.wide_blocks):
# a block is what is rebuilt when one of its ids changes.
WIDE_ID_BLOCK = 1_000_000
# Block folders of a wide table that a full build aims at; with more blocks a
# folder holds 2, 4, 8 ... neighbouring ones.
MAX_BLOCK_FOLDERS = 1024
# Ranges of changed ids that are written into a filter one by one; more are
# pushed down as one range and matched exactly by a join.
MAX_ID_RANGES = 32
# Changed blocks that are listed on the driver (a number each).
MAX_LISTED_BLOCKS = 100_000
# offset + limit above which a page is cut by a distributed rank instead of a
# per-task top-k buffer.
MAX_TOPK_ROWS = 200_000


def join_kind(category: str) -> str:
    """'aligned' (inner) for type1/type2, 'ragged' (full outer) otherwise."""
    return "aligned" if category in ALIGNED_CATEGORIES else "ragged"


def wide_table_name(category: str) -> str:
    return f"{WIDE_TABLE_PREFIX}{category}"
