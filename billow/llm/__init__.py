"""Operators for large-scale training-data preparation.

Each module holds one operator with its own general interface; ``queries``
applies them, with production parameters, to the test tables.  Nothing outside
this subpackage imports it.
"""
