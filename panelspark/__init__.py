"""Panel analytics on Spark: many multi-asset time-series panels per job, all in long tables."""

__version__ = "0.1.0"
