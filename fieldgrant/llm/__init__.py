"""Operators for preparing training corpora, and the queries registered for them.

Nothing else in the library imports this subpackage.
"""
