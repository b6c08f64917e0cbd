"""Landed responses: one row per response, as a table, as raw files or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("page_size", T.IntegerType()),
        T.StructField("share_code", T.StringType()),
    ]
)

# What Spark gives for each whole file.
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# A landing that several crawls feed also names the crawl of each response.
CRAWLED_SCHEMA = T.StructType([*LANDING_SCHEMA.fields, T.StructField("crawl", T.LongType())])


def read_landing(spark: SparkSession, path: str, feed: str | None = None, crawled: bool = False) -> DataFrame:
    """The landing table, cut to one feed by a filter that reaches the scan. How finely it is split is the session's
    choice (``spark.sql.files.maxPartitionBytes``). ``crawled``: it has the column ``crawl``."""
    landing = spark.read.schema(CRAWLED_SCHEMA if crawled else LANDING_SCHEMA).parquet(path)
    if feed is not None:
        landing = landing.where(F.col("feed") == feed)
    return landing


def _as_landing(files: DataFrame, feed: str) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)

    def part(folder: str, in_name: str) -> Column:
        folders = F.regexp_extract("path", rf"/{folder}=([^/]+)/", 1)
        return F.coalesce(F.nullif(folders, F.lit("")), F.nullif(F.regexp_extract(name, in_name, 1), F.lit("")))

    return files.select(
        F.lit(feed).alias("feed"),
        F.col("path").alias("url"),
        F.col("modificationTime").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.col("content").alias("body"),
        part("page_no", r"_(\d+)\.[^.]*$").try_cast("int").alias("page_no"),
        F.lit(None).cast("int").alias("page_size"),
        part("share_code", r"^(.*)_\d+\.[^.]*$").alias("share_code"),
    )


def read_landing_files(spark: SparkSession, path: str, feed: str, pattern: str = "*") -> DataFrame:
    """Raw bodies, one file per response. Share and page come from folders ``share_code=.../page_no=...``, as a
    partitioned write makes them, or from a ``<share>_<page>.<ext>`` file name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return _as_landing(files.load(path), feed)


def stream_landing_files(
    spark: SparkSession, path: str, feed: str, pattern: str = "*", max_files: int | None = None
) -> DataFrame:
    """``read_landing_files`` as a stream of newly landed files."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
    if max_files:
        files = files.option("maxFilesPerTrigger", max_files)
    return _as_landing(files.option("recursiveFileLookup", "true").load(path), feed)


def stream_landing(
    spark: SparkSession, path: str, feed: str | None = None, max_files: int | None = None, crawled: bool = False
) -> DataFrame:
    """The landing table as a stream of newly landed files."""
    reader = spark.readStream.schema(CRAWLED_SCHEMA if crawled else LANDING_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landing = reader.parquet(path)
    return landing if feed is None else landing.where(F.col("feed") == feed)


def deal_pages(landing: DataFrame) -> DataFrame:
    """The landed responses dealt to all cores. A landing is read in pieces no smaller than a row group of its files, and
    pages pack so well that one row group can hold most of a batch; parsing them is the costly part of a run."""
    cores = landing.sparkSession.sparkContext.defaultParallelism
    return landing.repartition(cores, "feed", "url", "share_code", "page_no", "fetched_at")
