"""Operators that prepare text corpora for training. Nothing outside this package imports it."""
