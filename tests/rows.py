"""Helpers to write test rows."""

import datetime as dt

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(pos: int, step_seconds: float = 1.0) -> dt.datetime:
    """Arrival time of the pos-th record."""
    return BASE + dt.timedelta(seconds=pos * step_seconds)
