"""Layered commerce warehouse on Spark: ingest, merge, model, check and report."""

__version__ = "0.1.0"
