"""Operators of a training-data pipeline: filters, search, packing, formats.

Nothing outside this subpackage imports it.
"""
