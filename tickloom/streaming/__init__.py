from .sinks import Commits, encode, route, route_by_window, start_sink, to_folders, to_outputs, write_each
from .watch import (
    Job,
    Observed,
    largest_keys,
    operators,
    state_by_partition,
    state_rows,
    watermark_of_batch,
)

__all__ = [
    "Commits",
    "Job",
    "Observed",
    "encode",
    "largest_keys",
    "operators",
    "route",
    "route_by_window",
    "start_sink",
    "state_by_partition",
    "state_rows",
    "to_folders",
    "to_outputs",
    "watermark_of_batch",
    "write_each",
]
