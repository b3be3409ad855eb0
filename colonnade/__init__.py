"""colonnade: reusable Spark DataFrame operators and composed batch analytics jobs.

Every operator is a function ``f(df, ...) -> DataFrame`` that only builds a lazy
Catalyst plan (or a ``pyspark.ml`` stage); column names are arguments.
"""

__version__ = "0.1.0"
