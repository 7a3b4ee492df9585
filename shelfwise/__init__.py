"""Spark-native profiling, preparation and regression for retail-style sales tables."""

from shelfwise.config import RETAIL, Roles

__all__ = ["RETAIL", "Roles"]
