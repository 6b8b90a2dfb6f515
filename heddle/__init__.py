"""heddle: a Spark-native engine for messy, multilingual purchasing data."""

__version__ = "0.1.0"
