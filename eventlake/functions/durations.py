"""Duration text such as ``"5 minutes"`` as microseconds."""

from __future__ import annotations

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Length of ``duration`` in microseconds; several ``<n> <unit>`` pairs add up."""
    words = duration.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit[:-1] if unit.endswith("s") else unit
        if name not in _UNIT_MICROS:
            raise ValueError(f"unknown unit in duration: {duration!r}")
        total += int(amount) * _UNIT_MICROS[name]
    return total
