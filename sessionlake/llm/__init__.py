"""Operators of a training-data pipeline over the ``documents`` table: dedup,
cleaning, scans, mixing and tokenising. Nothing else in the library imports
this package; ``queries`` holds its registered queries and their SQL."""
