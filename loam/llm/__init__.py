"""Operators of a training-data pipeline: formatting, cleaning, de-duplication, privacy, packing, search.

Nothing else in the library imports this subpackage.  Its queries are registered
in :mod:`loam.llm.queries`.
"""
