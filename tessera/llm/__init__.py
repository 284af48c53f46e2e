"""Operators that prepare large text corpora for language-model training.

Nothing outside this package imports it; deleting the folder leaves the rest of
the library whole.
"""
