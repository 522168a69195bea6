"""Event-time analytics over clickstream data, written as Spark DataFrame operators."""

__version__ = "0.1.0"
