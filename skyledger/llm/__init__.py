"""Operators of a training-data pipeline (language id, dedup, quality, tokens, mixing, PII).

Nothing outside this package imports it.  ``registry`` lists the test queries.
"""
