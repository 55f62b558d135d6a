"""Training-data operators: near-duplicate search, filters, scans, mixing, tokens.

Self-contained: nothing else in the library imports this subpackage.
"""
