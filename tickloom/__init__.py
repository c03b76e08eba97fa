"""Market-data analytics on Spark: trades in; bars, anomalies, marts and checks out."""

__version__ = "0.1.0"
