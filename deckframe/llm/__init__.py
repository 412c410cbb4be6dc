"""Operators for preparing training corpora.

Each module holds one operator with its own interface; ``registry`` binds them
to the driver tables.  Nothing outside this package imports it.
"""
