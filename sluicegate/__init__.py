"""Event-log governance on Spark: clean, de-duplicate, route late rows, keep a lake table."""

__version__ = "0.1.0"
