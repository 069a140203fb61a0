"""Spatio-temporal event analytics on Spark DataFrames."""

from cellpulse.config import GridConfig

__all__ = ["GridConfig"]
