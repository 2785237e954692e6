"""Operators for training-data pipelines over the tables documents, benchmark and pages."""
