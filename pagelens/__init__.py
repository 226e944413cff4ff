"""pagelens: a PySpark-native engine for document pages, their regions and the corpora made of them."""

__version__ = "0.1.0"
