"""Player-retention analytics on Spark: event logs to labels, features and models."""

__version__ = "0.1.0"
