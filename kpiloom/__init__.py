"""Governed operational analytics on transaction lines, expressed as Spark DataFrames."""

__version__ = "0.1.0"
