"""Monitoring of scores as they arrive."""

from .monitor import daily_counts, score_drift

__all__ = ["daily_counts", "score_drift"]
