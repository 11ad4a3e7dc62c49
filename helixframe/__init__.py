"""Spark DataFrame operators for tumour/normal sequencing tables and training-data corpora."""
