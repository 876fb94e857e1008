"""Spark-native operators for incremental, layered ETL and dimensional modelling.

Everything in the library is a plain ``DataFrame -> DataFrame`` function over built-in Spark expressions, or a thin sink
around ``DataFrameWriter``.  See ``README.md`` for the map of modules.
"""

__version__ = "0.1.0"
