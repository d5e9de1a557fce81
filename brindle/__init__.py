"""brindle: a PySpark-native engine; see README.md."""

__version__ = "0.1.0"
