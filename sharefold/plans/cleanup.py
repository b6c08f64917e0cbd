"""Removes what past batches and crawls leave beside the tables."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# By kind of folder below ``_lookups/<feed>/``: what only its own batch reads, and what a crawl needs while its pages land.
OF_BATCH, OF_CRAWL = ("shares", "last_pages"), ("ends", "marks", "started")


def _numbered(files, path, name: str) -> list[tuple[int, object]]:
    """Folders ``<name>=<number>`` right below ``path``."""
    if not files.exists(path):
        return []
    found = [status.getPath() for status in files.listStatus(path)]
    return [(int(m[1]), p) for p in found if (m := re.fullmatch(rf"{name}=(-?\d+)", p.getName()))]


def forget(
    spark: SparkSession,
    root: str,
    feed_name: str,
    before_batch: int,
    before_crawl: int | None = None,
    with_rejects: bool = False,
) -> int:
    """Deletes working files of batches below ``before_batch`` and tells how many folders went.

    Parsed pages and a batch's own look-ups go. Tables, metrics and the record of replays stay, and so do judged rows with
    the rejects among them, unless ``with_rejects``. Marks, start times and ends of walks stay while pages of their crawl may land;
    ``before_crawl`` deletes those of runs (crawls) below it. A batch that is deleted cannot run again or be replayed;
    the newest batch of a feed is kept if it is not below the number. Not to be called while the feed is taking a batch.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    files = make(root).getFileSystem(spark._jsc.hadoopConfiguration())
    tops = [f"_parsed/{feed_name}", *[f"_lookups/{feed_name}/{kind}" for kind in OF_BATCH]]
    tops += [f"_judged/{feed_name}"] if with_rejects else []
    gone = [
        batch
        for top in tops
        for _, run in _numbered(files, make(f"{root}/{top}"), "run")
        for number, batch in _numbered(files, run, "batch")
        if number < before_batch
    ]
    if before_crawl is not None:
        for kind in OF_CRAWL:
            gone += [run for number, run in _numbered(files, make(f"{root}/_lookups/{feed_name}/{kind}"), "run") if number < before_crawl]
    for path in gone:
        files.delete(path, True)
    return len(gone)
