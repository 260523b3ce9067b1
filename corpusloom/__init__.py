"""Corpus curation on Spark: deduplication, grouping, splits and chat data as DataFrame operators."""

__version__ = "0.1.0"
