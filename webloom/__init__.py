"""webloom: turn web pages and text corpora into relational data with PySpark."""

__version__ = "0.1.0"
