"""Durations written as text ("30 seconds", "1 hour") and their width in microseconds."""

from __future__ import annotations

# Microseconds per unit.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Width of a fixed-length duration. Months and years have no fixed width and are refused."""
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit.lower().rstrip("s")
        if name not in UNIT_MICROS:
            raise ValueError(f"unknown time unit {unit!r} in {duration!r}")
        total += int(amount) * UNIT_MICROS[name]
    return total


def interval(width: int) -> str:
    return f"{width} microseconds"
