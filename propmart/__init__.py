"""propmart — property-market analytics as Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
``pyspark.sql.functions``; only the readers, writers and jobs in
``propmart.sources`` / ``propmart.plans`` touch paths.  Nothing runs at import.
"""

__version__ = "0.1.0"
