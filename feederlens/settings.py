"""Limits of the load analysis and the fixed values shared by all modules."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data format.
UNUSABLE = 9999.99  # stands for "no usable number" in every measure and in the load rate
FIELD_COUNT = 18  # fields of a raw line: key, time and 16 measures

# Fixed values of the status columns.
NORMAL, HEAVY, OVERLOAD, NOT_COMPUTABLE, LATE = 0, 1, 2, 3, 4
NO_OVERLOAD, SHORT, LONG, SHORT_AFTER_LONG = 0, 1, 2, 3

MINUTE = 60_000
HOUR = 60 * MINUTE


@dataclass(frozen=True)
class Limits:
    """Parameters of the episode detection; the defaults are the utility's own rules.

    ``levels`` are the seven load rates that are tracked: the first marks heavy load, the second
    overload, the others decide with ``long_minutes`` whether an overload is a long one.
    ``slice_hours`` is the width of the time slices in which one measuring point is processed. It
    never changes a result, only how much work one task gets (see ``operators/runs.py``).
    """

    levels: tuple[float, ...] = (0.8, 1.0, 1.2, 1.3, 1.5, 1.6, 1.8)
    gap_minutes: int = 20
    confirm_minutes: int = 30
    hold_minutes: int = 15
    long_minutes: tuple[int, ...] = (480, 240, 120, 60, 30)
    grid_minutes: int = 15
    sticky_long: bool = False
    slice_hours: int = 6

    def __post_init__(self) -> None:
        if len(self.levels) != 7 or list(self.levels) != sorted(set(self.levels)):
            raise ValueError("levels must be seven increasing load rates")
        if len(self.long_minutes) != len(self.levels) - 2:
            raise ValueError("long_minutes needs one value per level above the overload level")
        if min(self.gap_minutes, self.confirm_minutes, self.hold_minutes, self.grid_minutes) <= 0:
            raise ValueError("gap, confirm, hold and grid minutes must be positive")
        if min(self.long_minutes) < self.confirm_minutes:
            raise ValueError("a long overload cannot be shorter than the confirmation time")
        if self.hold_minutes > self.confirm_minutes:
            raise ValueError("hold_minutes must not exceed confirm_minutes")
        if self.slice_ms < self.lookahead_ms:
            raise ValueError("slices must be at least as long as gap plus confirmation time")

    @property
    def gap_ms(self) -> int:
        return self.gap_minutes * MINUTE

    @property
    def confirm_ms(self) -> int:
        return self.confirm_minutes * MINUTE

    @property
    def hold_ms(self) -> int:
        return self.hold_minutes * MINUTE

    @property
    def slice_ms(self) -> int:
        return self.slice_hours * HOUR

    @property
    def lookahead_ms(self) -> int:
        """A pending run is confirmed at the latest this long after one of its readings."""
        return self.gap_ms + self.confirm_ms
