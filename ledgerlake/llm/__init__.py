"""Operators that prepare the corpus of documents. Nothing outside this package imports it."""
