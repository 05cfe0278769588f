"""gleaner: a Spark-native engine for collecting, curating and publishing
datasets.

Every operator is a plain function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst sees whole plans: filters reach the parquet scan,
columns are pruned, AQE picks join strategies at runtime.
"""

__version__ = "0.1.0"
