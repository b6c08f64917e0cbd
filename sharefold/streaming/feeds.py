"""Streams of landed rows into current tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sharefold.feeds import feed
from sharefold.operators.incremental import ALL, cut_mode
from sharefold.operators.merge import with_arrival
from sharefold.plans.ingest import ingest, ingest_crawls
from sharefold.sinks.tables import merge_into_table
from sharefold.sources.landing import deal_pages

# Fixed value: how late a row may be and still be recognised as a repeat.
LATENESS = "90 days"


def drop_repeats(stream: DataFrame, ident: Sequence[str], at: str, lateness: str = LATENESS) -> DataFrame:
    """First arrival of each id; the state of an id is dropped once the stream is ``lateness`` past it.

    Event time must be a TIMESTAMP for a watermark, so a wall-clock column is read in the session zone.
    """
    return (
        stream.withColumn("_event_time", F.col(at).cast("timestamp"))
        .withWatermark("_event_time", lateness)
        .dropDuplicatesWithinWatermark(list(ident))
        .drop("_event_time")
    )


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: tuple[str, ...],
    sticky: tuple[str, ...],
    partition: str,
    order: Sequence[str],
    available_now: bool = True,
    first_batch: int = 0,
) -> StreamingQuery:
    """Merges each micro-batch into the table at ``path``.

    A micro-batch is written once below ``path`` and merged from there. Its number leads the arrival order, so a
    batch that is delivered again after a failure changes nothing. A stream that starts over with a new checkpoint
    on an old table needs ``first_batch`` above the batches that table has seen.
    """

    def write(rows: DataFrame, batch: int) -> None:
        numbered = with_arrival(rows.withColumn("_batch", F.lit(first_batch + batch).cast("bigint")), ["_batch", *order])
        numbered.drop("_batch").write.mode("overwrite").parquet(f"{path}/landed")
        merge_into_table(rows.sparkSession.read.parquet(f"{path}/landed"), path, key, sticky, partition)

    return _start(stream, write, checkpoint, available_now)


def stream_feed(
    landing: DataFrame,
    feed_name: str,
    root: str,
    checkpoint: str,
    universe: DataFrame | None = None,
    available_now: bool = True,
    first_batch: int = 0,
    **options: object,
) -> StreamingQuery:
    """Runs ``ingest`` on each micro-batch of a landing stream; ``first_batch`` as in ``stream_upsert``.

    A period or newest-only timeline needs the landing's column ``crawl`` (see ``ingest_crawls``): a stream outlives many
    crawls, and each has marks of its own that are taken when its first page lands. Without it such a stream is refused.
    What each micro-batch read and changed is in ``run_metrics``.
    """
    spec, mode = feed(feed_name), cut_mode(str(options.get("mode", ALL)))
    crawled = spec.timeline and mode != ALL
    if crawled and "crawl" not in landing.columns:
        raise ValueError(f"a stream of {feed_name} in mode {mode} needs the column crawl")

    def write(rows: DataFrame, batch: int) -> None:
        take, pages = (ingest_crawls, rows) if crawled else (ingest, deal_pages(rows))
        take(pages, feed_name, root, first_batch + batch, universe=universe, **options)

    return _start(landing, write, checkpoint, available_now)
