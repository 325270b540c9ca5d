"""Keep a document corpus in sync and searchable with PySpark."""

__version__ = "0.1.0"
