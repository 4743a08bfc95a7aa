"""Column-level helpers: pure expressions, no actions, no shuffles."""

from .timecols import epoch_seconds, from_epoch_seconds, with_calendar, epoch_ms_to_ts
from .grid import with_grid
from .metrics import abs_err, ape_term, sq_err, MAPE_EPS

__all__ = [
    "epoch_seconds", "from_epoch_seconds", "with_calendar", "epoch_ms_to_ts",
    "with_grid", "abs_err", "ape_term", "sq_err", "MAPE_EPS",
]
