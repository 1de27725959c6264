"""Batch intervals as text."""

from __future__ import annotations

_UNITS = {"second": "seconds", "seconds": "seconds", "minute": "minutes", "minutes": "minutes"}


def trigger_interval(text: str) -> str:
    """``"5 second"`` or ``"3 minutes"`` as a trigger interval; other units are an error."""
    parts = text.split()
    if len(parts) != 2 or not parts[0].isdigit() or int(parts[0]) == 0:
        raise ValueError(f"not an interval: {text!r}")
    unit = _UNITS.get(parts[1].lower())
    if unit is None:
        raise ValueError(f"unknown unit in {text!r}: use second or minute")
    return f"{int(parts[0])} {unit}"
