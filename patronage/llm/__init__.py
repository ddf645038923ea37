"""Operators that prepare text corpora for language-model training.

Nothing else in the package imports this subpackage. ``registry`` lists its
queries, ``oracles`` their DuckDB statements where SQL can express them.
"""
