"""Corpus operators: dedup, search, classifiers, tokens, packing and page extraction on DataFrames."""
