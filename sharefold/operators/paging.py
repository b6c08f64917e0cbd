"""Numbered pages of an ordered table, however deep they lie.

A numbered page needs the rank of its first row. The table is laid out once by ranges of its order, with the number of
rows in each range; a page is then found by adding up those numbers, and only the ranges it lies in are read and sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE = "_range"


def write_page_index(df: DataFrame, order: Sequence[Column], path: str, ranges: int | None = None) -> None:
    """Lays ``df`` out below ``path`` for ``indexed_page``. ``order`` should end in a unique column: rows that tie in it
    stand in one range together. ``ranges`` defaults to the session's number of shuffle partitions; a page costs about one
    of them, so take more for a larger table. What lies at ``path`` is replaced."""
    if RANGE in df.columns:
        raise ValueError(f"the table has a column {RANGE} already")
    count = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of a range partition is its place in the order.
    laid = df.repartitionByRange(count, *order).withColumn(RANGE, F.spark_partition_id())
    laid.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
    numbers = df.sparkSession.read.schema(laid.schema).parquet(f"{path}/rows").groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"))
    numbers.write.mode("overwrite").parquet(f"{path}/numbers")
    df.limit(0).write.mode("overwrite").parquet(f"{path}/columns")


def indexed_page(spark: SparkSession, path: str, order: Sequence[Column], page: int, size: int) -> DataFrame:
    """The rows of one page, in order; none beyond the last page. ``order`` is that of the index. The numbers of the
    ranges come to the driver, one row for each range."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    first, last = (page - 1) * size, page * size
    passed, skipped, wanted = 0, 0, []
    for number in spark.read.parquet(f"{path}/numbers").orderBy(RANGE).collect():
        if passed < last and passed + number.rows > first:
            skipped = skipped if wanted else first - passed
            wanted.append(number[RANGE])
        passed += number.rows
    columns = spark.read.parquet(f"{path}/columns")
    if not wanted:
        return columns
    rows = spark.read.parquet(f"{path}/rows").where(F.col(RANGE).isin(wanted)).select(*columns.columns)
    return rows.orderBy(*order).offset(skipped).limit(size)
