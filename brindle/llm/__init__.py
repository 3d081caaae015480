"""Operators for preparing language-model training corpora.

Nothing outside this subpackage (but for the guarded lookup in ``__spark_entry__.py``) imports it.
Every operator takes a DataFrame and column names, selects only the columns it needs (extra or clashing
columns are ignored) and returns a DataFrame of its own.
"""
