from .first_move import first_higher, first_lower, first_move
from .ingest import REASONS, check_ticks, good_ticks, reason_counts, rejected_messages, validate_ticks
from .window_stats import late_for, regroup_stats, stats_array, window_stats
from .zscore import tick_zscores, zscore_array, zscore_rows, zscores

__all__ = [
    "REASONS",
    "check_ticks",
    "first_higher",
    "first_lower",
    "first_move",
    "good_ticks",
    "late_for",
    "reason_counts",
    "regroup_stats",
    "rejected_messages",
    "stats_array",
    "tick_zscores",
    "validate_ticks",
    "window_stats",
    "zscore_array",
    "zscore_rows",
    "zscores",
]
