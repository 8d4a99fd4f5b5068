"""Training-data operators: quality, duplicates, personal data, language, packing.

Nothing else in the library imports this subpackage.
"""
