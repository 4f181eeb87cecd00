"""tripwright: a PySpark-native engine for reliable trip-history data."""

__version__ = "0.1.0"
