"""Training-data operators: scoring, filtering, deduplication, mixing, tokenising.

Nothing else in the library imports this subpackage.  Each operator lives in its
own module with a general interface; ``catalog`` holds the registered queries.
"""
