"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharefold.session import scratch_path
from sharefold.sinks import pin


def components(links: DataFrame) -> DataFrame:
    """Of links (a, b): id and comp, the smallest id that is reachable, for every id in a link.

    Each round ties all larger neighbours of a node to its smallest one, then all smaller ones. Rounds are written to
    the shared folder, which cuts lineage. Their number grows with the logarithm of a component's size; they end when
    a round changes nothing.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = pin(edges, scratch_path(spark, "edges"))
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = pin(large.distinct(), scratch_path(spark, "edges"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = pin(small.where("a <> b").distinct(), scratch_path(spark, "edges"))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
