"""Operators of a training-data pipeline: archives, tokens, duplicates, filters.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries when the subpackage is present.
"""
