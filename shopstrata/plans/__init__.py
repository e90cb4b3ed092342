"""Compositions: jobs that write tables, and the catalogue of named queries."""
