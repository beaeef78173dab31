"""Viewloom: media-engagement analytics expressed as PySpark DataFrame jobs."""

__version__ = "0.1.0"
