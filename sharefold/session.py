"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every operator is written against. ANSI mode stays on, as Spark ships it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Both let Spark itself decode GBK, with a mark in place of what cannot be decoded.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "sharefold", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def jvm_charsets(spark: SparkSession, replace: bool = True) -> Iterator[None]:
    """Lets queries that are built inside read and write any charset of the JVM without Python. An expression takes these
    settings up when it is analysed, so the session gets its own back at the end. What a charset does not have becomes a
    mark; it ends the job without ``replace``."""
    wanted = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": str(replace).lower()}
    own = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in own.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: what the session names. A local master may do without and gets a local
    folder; anywhere else a missing name is an error, since executors would write to disks of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "sharefold-scratch")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/sharefold/{label}-{uuid.uuid4().hex}"
