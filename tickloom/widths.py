"""The window widths every operator works with."""

from __future__ import annotations

from typing import NamedTuple


class Width(NamedTuple):
    label: str
    seconds: int

    @property
    def micros(self) -> int:
        return self.seconds * 1_000_000


# The six window labels and their length in seconds.
SIX = (
    Width("30s", 30),
    Width("1m", 60),
    Width("5m", 300),
    Width("15m", 900),
    Width("30m", 1800),
    Width("1h", 3600),
)

LABELS = tuple(w.label for w in SIX)


def pick(*labels: str) -> tuple[Width, ...]:
    """The widths with the given labels, shortest first."""
    unknown = set(labels) - set(LABELS)
    if unknown:
        raise ValueError(f"unknown window labels {sorted(unknown)}; known: {list(LABELS)}")
    return tuple(w for w in SIX if w.label in labels)


def nested(widths) -> tuple[Width, ...]:
    """Widths sorted shortest first, checked to nest: each divides the next.

    Nesting is what lets one `block` (the longest width) hold every window of
    a tick, and shorter windows be added up into longer ones.
    """
    ordered = tuple(sorted((Width(*w) for w in widths), key=lambda w: w.seconds))
    if not ordered:
        raise ValueError("at least one width is needed")
    if len({w.label for w in ordered}) < len(ordered):
        raise ValueError("window labels must be distinct")
    for a, b in zip(ordered, ordered[1:]):
        if b.seconds % a.seconds or a.seconds == b.seconds:
            raise ValueError(f"{a.label} does not nest in {b.label}")
    return ordered
