"""Structured Streaming operators (2.17, re-aimed batch schedules)."""

from quarry.streaming.windows import window_totals, run_window_totals  # noqa: F401
from quarry.streaming.incremental import load_increment  # noqa: F401
