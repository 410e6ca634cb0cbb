"""opsmetrics: warehouse-worker productivity reports as Spark DataFrame plans."""

__version__ = "0.1.0"
