"""Checks of the streaming forms: the events file as a stream, read to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.events import DAILY_SQL
from checks.registry import check, json_pages, table
from sharefold import feeds as fd
from sharefold.operators.parse import parse_feed
from sharefold.session import scratch_path
from sharefold.sinks import read_stored
from sharefold.sources import read_landing_files, stream_landing, stream_landing_files
from sharefold.streaming import drop_repeats, stream_upsert


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@check(DAILY_SQL)
def stream_upsert_query(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("user_id", F.to_date("ts").alias("date"), "event_type", "value", "ts")
    path = scratch_path(spark, "stream-upsert")
    query = stream_upsert(
        rows, path, f"{path}/checkpoint", ("user_id", "date"), ("event_type",), "date", order=["ts"]
    )
    query.awaitTermination()
    return read_stored(spark, path).select("user_id", "date", "event_type", "value")


@check("SELECT event_id, user_id, ts FROM events")
def stream_dedup(spark, sf_dir):
    """Every row delivered twice; the sink sees each id once."""
    rows = event_stream(spark, sf_dir).select("event_id", "user_id", "ts")
    path = scratch_path(spark, "stream-dedup")
    once = drop_repeats(rows.unionByName(rows), ["event_id"], "ts")
    query = (
        once.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/rows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows")


FILES_SQL = """
    SELECT lpad(CAST(c_custkey // 2000 AS VARCHAR), 6, '0') AS share_code, CAST(c_custkey // 500 % 4 + 1 AS INTEGER) AS page_no,
      CAST(c_custkey AS VARCHAR) AS last_update_time, CAST(c_nationkey AS DOUBLE) AS main_influx_price, c_mktsegment = 'BUILDING' AS building
    FROM customer"""


def landed_bodies(spark, sf_dir):
    """Raw responses as files, below a folder for each share and page: blocks of 500 customers."""
    key, path = F.col("c_custkey"), scratch_path(spark, "landed-files")
    unit = F.concat_ws(",", key, "c_nationkey", F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0))
    pages = json_pages(table(spark, sf_dir, "customer"), F.floor(key / 500), "c_custkey", unit)
    bodies = pages.select(
        F.lpad(F.floor(F.col("page") / 4).cast("string"), 6, "0").alias("share_code"),
        (F.col("page") % 4 + 1).cast("int").alias("page_no"),
        F.concat(F.lit("var aff_data={data:["), F.to_json("units"), F.lit("]}")).alias("body"),
    )
    bodies.write.partitionBy("share_code", "page_no").text(path)
    return path


def influx_rows(landing):
    rows = parse_feed(landing, fd.feed("main_influx"))
    return rows.select("share_code", "page_no", "last_update_time", "main_influx_price", (F.col("main_influx_ratio") > 0).alias("building"))


@check(FILES_SQL)
def landed_files(spark, sf_dir):
    return influx_rows(read_landing_files(spark, landed_bodies(spark, sf_dir), "main_influx"))


@check(FILES_SQL)
def stream_landed_files_query(spark, sf_dir):
    """Files streamed into a landing table, and that one streamed on into rows."""
    path = scratch_path(spark, "stream-landed")
    bodies = stream_landing_files(spark, landed_bodies(spark, sf_dir), "main_influx")
    for name, rows in (("landing", lambda: bodies), ("rows", lambda: influx_rows(stream_landing(spark, f"{path}/landing", "main_influx")))):
        writer = rows().writeStream.format("parquet").option("checkpointLocation", f"{path}/{name}-checkpoint")
        writer.trigger(availableNow=True).start(f"{path}/{name}").awaitTermination()
    return spark.read.parquet(f"{path}/rows")
