"""Operators that prepare language-model training data at scale."""
