"""lexispark: corpus annotation, collocation and search operators as PySpark DataFrame plans."""

__version__ = "0.1.0"
