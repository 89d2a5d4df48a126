"""Operators of a training-data pipeline over documents, pages and benchmarks.

Nothing else in the library imports this subpackage. Its registered queries are in
``queries``, the SQL they are checked against in ``oracle``.
"""
