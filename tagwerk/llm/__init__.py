"""Training-data operators: deduplication, extraction, scoring, mixing, token output.

Nothing else in the library imports this package.  ``queries`` registers one
query per operator.
"""
