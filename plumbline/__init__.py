"""Plumbline: listings reconciliation, identity, coverage and quality operators on Spark DataFrames."""

__version__ = "0.1.0"
