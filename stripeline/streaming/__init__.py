"""Declared tables as streams."""

from .windows import finished, late_tolerant_counts, running_totals, sessions

__all__ = ["finished", "late_tolerant_counts", "running_totals", "sessions"]
