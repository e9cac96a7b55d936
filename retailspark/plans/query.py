"""The shape of a registered query."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Takes the session and the folder of the star-schema Parquet tables.
Query = Callable[[SparkSession, str], DataFrame]
