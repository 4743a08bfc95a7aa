"""The one value object every operator takes: which columns form a keyed series."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def step_to_seconds(step: str | int) -> int:
    """'10 minutes' -> 600; ints are taken as seconds."""
    if isinstance(step, int):
        return step
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", step.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported step {step!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


@dataclass(frozen=True)
class SeriesSpec:
    """A keyed, time-ordered series stored long: one row per (key..., time).

    key     -- columns identifying a series (one or more)
    time    -- TIMESTAMP / TIMESTAMP_NTZ column
    value   -- numeric column
    step    -- sampling step of the regular grid ('10 minutes', '1 hour', '1 day')
    period  -- seasonal period in steps (144 for a daily cycle of 10-minute steps)
    block   -- rows per block for positional (window) operators. A series is cut
               into blocks of this many positions so that no single task ever
               holds a whole series, however long or hot it is.
    """

    key: tuple = ("square_id",)
    time: str = "ts"
    value: str = "y"
    step: str = "10 minutes"
    period: int = 144
    block: int = 8192
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if isinstance(self.key, str):
            object.__setattr__(self, "key", (self.key,))
        else:
            object.__setattr__(self, "key", tuple(self.key))

    @property
    def step_seconds(self) -> int:
        return step_to_seconds(self.step)

    @property
    def keys(self) -> list:
        return list(self.key)

    def with_(self, **kw) -> "SeriesSpec":
        return replace(self, **kw)
