"""Shot-quality analytics on Spark: events, expected points, retraining, reports."""

__version__ = "0.1.0"
