"""Interval strings (``"5 seconds"``, ``"2 hours"``) as microseconds."""

from __future__ import annotations

import re

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}

_PART = re.compile(r"(\d+)\s*([a-z]+?)s?\b")


def to_micros(duration: str) -> int:
    """Micros of a fixed-length interval string such as ``"1 hour 30 minutes"``."""
    total = 0
    text = duration.strip().lower()
    matched = 0
    for number, unit in _PART.findall(text):
        if unit not in _UNIT_MICROS:
            raise ValueError(f"unsupported interval unit in {duration!r}")
        total += int(number) * _UNIT_MICROS[unit]
        matched += 1
    if not matched or total <= 0:
        raise ValueError(f"cannot parse interval {duration!r}")
    return total
