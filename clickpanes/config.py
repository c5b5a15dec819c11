"""Job parameters shared by batch and streaming plans."""

from __future__ import annotations

import re
from dataclasses import dataclass

_UNITS = {
    "second": 1,
    "seconds": 1,
    "minute": 60,
    "minutes": 60,
    "hour": 3600,
    "hours": 3600,
    "day": 86400,
    "days": 86400,
}


def interval_seconds(text: str) -> int:
    """Seconds in an interval string such as ``'1 hour'`` or ``'5 minutes'``."""
    m = re.fullmatch(r"\s*(\d+)\s+([a-z]+)\s*", text.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


@dataclass(frozen=True)
class ViewWindow:
    """Sliding event-time window: ``size`` long, a new one every ``slide``.

    ``delay`` is the watermark delay of the streaming form; the reference
    uses the window size for it.
    """

    size: str = "1 hour"
    slide: str = "5 minutes"
    delay: str | None = None

    def __post_init__(self) -> None:
        if self.slide_s > self.size_s:
            raise ValueError(f"slide {self.slide!r} is longer than the window {self.size!r}")

    @property
    def size_s(self) -> int:
        return interval_seconds(self.size)

    @property
    def slide_s(self) -> int:
        return interval_seconds(self.slide)

    @property
    def delay_text(self) -> str:
        return self.delay or self.size

    @property
    def windows_per_event(self) -> int:
        return -(-self.size_s // self.slide_s)


# Fixed values of the reference jobs: production and test-mode windows.
DEFAULT_WINDOW = ViewWindow("1 hour", "5 minutes")
DEV_WINDOW = ViewWindow("5 minutes", "1 minute")

# Number of rows in a featured report and the default state
# for clicks whose zip code is unknown.
FEATURED_N = 10
UNKNOWN_STATE = "Unknown"
