"""Operators that prepare text and vectors for language-model training.

Nothing outside this folder imports it.
"""
