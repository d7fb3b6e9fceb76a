"""Analytics over price ticks: DataFrame in, DataFrame out, on batch tables and streams."""

from .operators import (
    first_higher,
    first_lower,
    first_move,
    regroup_stats,
    stats_array,
    tick_zscores,
    validate_ticks,
    window_stats,
    zscore_array,
    zscore_rows,
    zscores,
)
from .session import configure
from .sources import decode, explode_stats, explode_zscores, read_messages, ticks_from
from .widths import LABELS, SIX, Width, pick

__all__ = [
    "LABELS",
    "SIX",
    "Width",
    "configure",
    "decode",
    "explode_stats",
    "explode_zscores",
    "first_higher",
    "first_lower",
    "first_move",
    "pick",
    "read_messages",
    "regroup_stats",
    "stats_array",
    "tick_zscores",
    "ticks_from",
    "validate_ticks",
    "window_stats",
    "zscore_array",
    "zscore_rows",
    "zscores",
]
