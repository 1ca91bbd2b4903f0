"""Spark operators for health-plan rate disclosure files."""

__version__ = "0.1.0"
