"""Transformer load analytics on Spark: clean meter readings, compute load rates, find overload episodes."""

from feederlens.settings import Limits

__all__ = ["Limits"]
