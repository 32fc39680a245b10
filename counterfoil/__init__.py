"""Reconciles browser-side events with server-side transactions on Spark.

Every operator is a function from DataFrames to a DataFrame. Nothing runs until
the caller writes or collects the result.
"""

__version__ = "0.1.0"
