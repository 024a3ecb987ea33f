"""Spark jobs for tables of sequencing reads and for training-data corpora."""
