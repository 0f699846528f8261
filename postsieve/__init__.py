"""Spark operators that turn incoming mail and scanned documents into clean,
masked and labelled text corpora."""

__version__ = "0.1.0"
