"""Layered (bronze / silver / gold) sales analytics on Spark DataFrames.

``functions``  Column -> Column building blocks
``operators``  DataFrame -> DataFrame steps, usable with ``DataFrame.transform``
``sources``    CSV scans, schema locks, versioned Parquet tables, shared scratch
``plans``      the ten table builds and the end-to-end refresh
"""

__version__ = "0.1.0"
