"""finlake: a Spark-native batch finance-analytics engine."""

__version__ = "0.1.0"
