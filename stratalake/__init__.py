"""Medallion lakehouse analytics for e-commerce data on plain Apache Spark."""

__version__ = "0.1.0"
