"""The register of check queries and helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(sql: str):
    """Registers a query under its function's name (without ``_query``), with its SQL."""

    def add(query: Callable[[SparkSession, str], DataFrame]):
        name = query.__name__.removesuffix("_query")
        QUERIES[name] = query
        SQL[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table whose rows are costly to work on, dealt to all cores: the given files are single splits."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism, *keys)


def epoch_ms(ts: Column | str) -> Column:
    """Epoch ms of a wall-clock column read as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp"))


def json_pages(units: DataFrame, page: Column, order: str, unit: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bounded pages of units in ``order``: columns ``page``, ``keep`` and ``units`` (array in order).

    ``page`` must map a unique key to blocks of a fixed number of keys, which bounds the size of every group.
    """
    grouped = units.groupBy(page.alias("page"), *keep).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), unit.alias("u")))).alias("sorted")
    )
    return grouped.select("page", *keep, F.col("sorted.u").alias("units"))


def text_array(units: Column | str) -> Column:
    """JSON text of an array of plain texts."""
    return F.to_json(units)
