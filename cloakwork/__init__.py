"""Consistent pseudonymisation of relational data on Spark."""

__version__ = "0.1.0"
