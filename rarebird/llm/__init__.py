"""Operators of a training-data pipeline over `documents`, `pages` and `benchmark` tables.

Nothing outside this package imports it (but for the guarded import in ``__spark_entry__.py``).
"""
