"""Sensor time-series processing on Spark: pad, correct, check, infill, aggregate and derive, for all sites at once."""

from tidemark.spec import Period, SeriesSpec

__all__ = ["Period", "SeriesSpec"]
