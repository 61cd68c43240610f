"""Training-data operators: near-dedup, filters, scoring, extraction, search, tokenisation.

One module per operator, each with its own general interface over DataFrames;
``queries`` holds the thin registered queries. Nothing else in the library
imports this subpackage.
"""
