"""Helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of rows that go to a Python task at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Holds the session to batches of BATCH_BYTES. A batch stands in memory several times over, as Arrow buffers on both
    sides and as Python objects, in every task of an executor; by itself Spark makes one batch of a whole split of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def with_settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row. Filters on it and uses inside lambdas do not pull its
    expression in and evaluate it again, as they do with a plain column, since it comes out of a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))
