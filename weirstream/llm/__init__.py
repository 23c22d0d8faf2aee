"""Operators for text corpora of language models. Nothing outside this package imports it."""
