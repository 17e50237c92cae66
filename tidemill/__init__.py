"""Comment-corpus analytics on Spark: DataFrame operators, sources, functions and streaming replay."""

__version__ = "0.1.0"
