"""Stored tables from files or from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A stored table. ``fmt="jdbc"`` takes the table name as ``location`` and Spark's JDBC options.

    For a large database table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``,
    or Spark reads it through one connection.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("dbtable", location).load()
    return reader.load(location)
