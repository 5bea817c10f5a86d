"""Training-data operators: text filtering, deduplication, tokenization and formatting.

Nothing else in the library imports this subpackage.
"""
