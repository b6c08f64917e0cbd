"""Checks over the events table: upserts, marks, wrappers, clocks, fetch logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, epoch_ms, table, wide_table
from sharefold.feeds import ANNOUNCEMENT, SHARE_BUYBACK
from sharefold.functions import (
    bj_to_epoch,
    epoch_to_bj,
    unwrap_assignment,
    unwrap_jsonp,
    zero_if_null,
)
from sharefold.functions.clock import MINUTE_PATTERN
from sharefold.operators.merge import latest_by_key, upsert, with_arrival
from sharefold.operators.parse import envelope_schema, explode_units, lenient_json, parse_envelope, project_keys
from sharefold.operators.planning import classify_fetches, endpoint_scorecard, progress, usable_endpoints
from sharefold.operators.shares import high_water, share_universe
from sharefold.operators.store import with_reasons
from sharefold.session import scratch_path
from sharefold.sinks import merge_into_table, pin, read_stored, write_routed


@check("SELECT user_id, arg_max(event_type, ts) AS event_type FROM events WHERE event_type IS NOT NULL GROUP BY user_id")
def share_universe_query(spark, sf_dir):
    return share_universe(table(spark, sf_dir, "events"), code="user_id", kind="event_type", name=None, at="ts")


@check(
    "SELECT event_type, max(event_id) AS max_id, max(strftime(ts, '%Y-%m-%d %H:%M')) AS max_at "
    "FROM events GROUP BY event_type"
)
def high_water_query(spark, sf_dir):
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    marks = high_water(table(spark, sf_dir, "events").withColumn("minute", minute), "event_type", "event_id", "minute")
    return marks.withColumn("max_at", F.date_format("max_at", MINUTE_PATTERN))


def daily(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("user_id", F.to_date("ts").alias("date"), "event_type", "value", "ts")


DAILY_SQL = (
    "SELECT user_id, CAST(ts AS DATE) AS date, arg_min(event_type, ts) AS event_type, arg_max(value, ts) AS value "
    "FROM events GROUP BY 1, 2"
)


@check(DAILY_SQL)
def upsert_daily_snapshot(spark, sf_dir):
    rows = latest_by_key(daily(spark, sf_dir), ["user_id", "date"], ["event_type"], ["ts"])
    return rows.select("user_id", "date", "event_type", "value")


@check(DAILY_SQL)
def upsert_merge(spark, sf_dir):
    """Two batches into a stored table, the newer one first, so the order must come from the arrivals."""
    rows = with_arrival(daily(spark, sf_dir), ["ts"]).drop("ts")
    path = scratch_path(spark, "upsert-merge")
    border = F.lit("2024-01-16").cast("date")
    for batch in (rows.where(F.col("date") >= border), rows.where(F.col("date") <= border)):
        merge_into_table(pin(batch, f"{path}/landed"), path, ("user_id", "date"), ("event_type",), "date")
    return read_stored(spark, path).select("user_id", "date", "event_type", "value")


@check("SELECT event_id, user_id, value + 1 AS value FROM events")
def upsert_by_id(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    stored = with_arrival(events.withColumn("batch", F.lit(1)), ["batch"]).drop("batch")
    again = events.withColumns({"value": F.col("value") + 1, "user_id": F.col("user_id") + 1000})
    incoming = with_arrival(again.withColumn("batch", F.lit(2)), ["batch"]).drop("batch")
    return upsert(stored, incoming, ["event_id"], ["user_id"]).select("event_id", "user_id", "value")


@check(
    "SELECT CAST(event_id * 10 // (SELECT max(event_id) + 1 FROM events) AS BIGINT) AS id_range, count(*) AS n, max(event_id) AS top "
    "FROM events GROUP BY 1"
)
def upsert_touched_ranges(spark, sf_dir):
    """Ids stored in two batches, partitioned into ten ranges of ids; no id may be doubled or lost."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    top = events.agg(F.max("event_id").alias("top")).head().top
    events = events.withColumn("id_range", F.floor(F.col("event_id") * 10 / F.lit(top + 1)).cast("bigint"))
    rows = with_arrival(events, ["ts"]).drop("ts")
    path = scratch_path(spark, "upsert-ranges")
    for batch in (rows.where(F.col("value") < 100), rows):
        merge_into_table(pin(batch, f"{path}/landed"), path, ("event_id",), ("user_id",), "id_range")
    stored = read_stored(spark, path)
    return stored.groupBy(F.col("id_range").cast("bigint").alias("id_range")).agg(
        F.count("event_id").alias("n"), F.max("event_id").alias("top")
    )


@check("SELECT event_type AS feed, count(*) AS n FROM events GROUP BY 1")
def route_by_feed(spark, sf_dir):
    path = scratch_path(spark, "routed")
    events = table(spark, sf_dir, "events")
    write_routed(events.withColumnRenamed("event_type", "feed"), path)
    return spark.read.parquet(path).groupBy("feed").agg(F.count(F.lit(1)).alias("n"))


@check(
    "SELECT concat_ws('; ', CASE WHEN value >= 10 THEN NULL ELSE 'small value' END, "
    "CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 90 THEN NULL ELSE 'k too high' END) AS reject_reason, "
    "count(*) AS n FROM events GROUP BY 1"
)
def quarantine_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("value", lenient_json("props", "k int").alias("p"))
    rules = {"small value": F.col("value") >= 10, "k too high": F.col("p.k") < 90}
    return with_reasons(events, rules).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


K_SQL = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"


@check(K_SQL)
def unwrap_jsonp_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit("jQuery("), "props", F.lit(");\n"))
    return events.select("event_id", lenient_json(unwrap_jsonp(text), "k int").alias("p")).select("event_id", "p.k")


@check(K_SQL)
def unwrap_assignment_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit("var x="), "props")
    return events.select("event_id", lenient_json(unwrap_assignment(text), "k int").alias("p")).select(
        "event_id", "p.k"
    )


@check(K_SQL)
def lenient_json_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bare = F.replace("props", F.lit('"'), F.lit(""))
    return events.select("event_id", lenient_json(bare, "k int").alias("p")).select("event_id", "p.k")


@check(
    "SELECT user_id AS symbol, event_type AS name, value AS buyback_price_range_right, "
    "strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS announcement_date, "
    "'1970-01-01 08:00:00' AS begin_date "
    "FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, value, ts FROM events)"
)
def key_rename(spark, sf_dir):
    unit = F.to_json(
        F.struct(
            F.col("user_id").alias("dim_scode"),
            F.col("event_type").alias("securityshortname"),
            F.col("value").alias("repurpricecap"),
            epoch_ms("ts").alias("dim_tradedate"),
        )
    )
    body = F.concat(F.lit("{pages: 1, data: ["), unit, F.lit("]}"))
    events = wide_table(spark, sf_dir, "events", "event_id")
    pages = events.select(lenient_json(body, envelope_schema(SHARE_BUYBACK)).alias("e"))
    units = explode_units(pages.select(F.col("e.data").alias("units")))
    items = project_keys(units, SHARE_BUYBACK.fields)
    return items.select("symbol", "name", "buyback_price_range_right", "announcement_date", "begin_date")


@check(
    "SELECT 'documents' AS src, 'refetch' AS page_state, count(*) AS n FROM documents "
    "UNION ALL SELECT 'events', 'ok', count(*) FROM events"
)
def corrupt_split(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.lit("documents").alias("src"), F.col("text").alias("t"))
    envelope = F.concat(F.lit("{page: 1, maxPage: 1, count: 20, list: [{id: 1, description: 'd'}], x: "), "props", F.lit("}"))
    events = table(spark, sf_dir, "events").select(F.lit("events").alias("src"), envelope.alias("t"))
    pages = documents.unionByName(events).select("src", F.encode("t", "UTF-8").alias("body"))
    return parse_envelope(pages, ANNOUNCEMENT).groupBy("src", "page_state").agg(F.count(F.lit(1)).alias("n"))


@check(
    "SELECT event_type, max(event_id) AS total_rows, max((event_id // 20) * 20) AS covered_rows, "
    "max(event_id) - max((event_id // 20) * 20) AS remaining_rows FROM events GROUP BY 1"
)
def progress_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    pages = events.select(
        "event_type", "event_id", F.floor(F.col("event_id") / 20).alias("page"), F.lit(20).alias("size")
    )
    return progress(pages, "event_id", "page", "size", by=["event_type"])


@check(
    "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS by_second, "
    "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS by_minute, '' AS unknown_unit FROM events"
)
def epoch_to_bj_query(spark, sf_dir):
    ms = table(spark, sf_dir, "events").select("event_id", epoch_ms("ts").alias("ms"))
    return ms.select(
        "event_id",
        epoch_to_bj("ms", "ms").alias("by_second"),
        epoch_to_bj(F.floor(F.col("ms") / 1000), "s", MINUTE_PATTERN).alias("by_minute"),
        epoch_to_bj("ms", "days").alias("unknown_unit"),
    )


@check(
    "SELECT event_id, epoch_ms(date_trunc('minute', ts) - INTERVAL 8 HOUR) AS ms, "
    "epoch_ms(date_trunc('minute', ts) - INTERVAL 8 HOUR) // 1000 AS s FROM events"
)
def bj_to_epoch_query(spark, sf_dir):
    text = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", MINUTE_PATTERN).alias("t"))
    return text.select(
        "event_id",
        bj_to_epoch("t", "ms", MINUTE_PATTERN).alias("ms"),
        bj_to_epoch("t", "s", MINUTE_PATTERN).alias("s"),
    )


@check(
    "SELECT event_id, CASE WHEN event_type = 'error' THEN '1970-01-01 08:00:00' ELSE "
    "strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS day, "
    "event_type = 'error' AS is_missing FROM events"
)
def null_date_sentinel(spark, sf_dir):
    ms = F.when(F.col("event_type") != "error", epoch_ms("ts"))
    rows = table(spark, sf_dir, "events").select("event_id", ms.alias("ms"))
    return rows.select(
        "event_id", epoch_to_bj(zero_if_null("ms"), "ms").alias("day"), F.col("ms").isNull().alias("is_missing")
    )


def fetch_log(spark, sf_dir):
    """Events read as a fetch log: the type stands for the outcome, the user for the endpoint."""
    kind = F.col("event_type")
    status = F.when(kind.isin("click", "view"), 200).when(kind == "signup", 404).when(kind == "purchase", 503)
    error = F.when(kind == "error", F.when(F.col("value") > 50, "TimeoutError").otherwise("ParseError"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("endpoint"), "ts", status.alias("status"), error.alias("error")
    )


CLASS_SQL = (
    "CASE event_type WHEN 'click' THEN 'accept' WHEN 'view' THEN 'accept' WHEN 'signup' THEN 'retry' "
    "WHEN 'purchase' THEN 'switch' ELSE CASE WHEN value > 50 THEN 'switch_connection' ELSE 'plain_retry' END END"
)


@check(f"SELECT {CLASS_SQL} AS fetch_class, count(*) AS n FROM events GROUP BY 1")
def response_class(spark, sf_dir):
    log = classify_fetches(fetch_log(spark, sf_dir), expected=[404])
    return log.groupBy("fetch_class").agg(F.count(F.lit(1)).alias("n"))


CARD_SQL = f"""
WITH log AS (SELECT user_id AS endpoint, ts, {CLASS_SQL} AS c FROM events),
card AS (
  SELECT endpoint, count(*) AS uses, count_if(c = 'switch') AS bad_status,
    count_if(c = 'switch_connection') AS bad_connection, max(CASE WHEN c = 'accept' THEN ts END) AS last_good_at
  FROM log GROUP BY endpoint)
SELECT endpoint, uses, CAST(bad_status AS BIGINT) AS bad_status, CAST(bad_connection AS BIGINT) AS bad_connection,
  last_good_at, CASE WHEN endpoint = 0 OR bad_status + bad_connection = 0 THEN 'keep' WHEN uses < 20 THEN 'drop'
    WHEN bad_status = 0 AND uses >= 200 THEN 'keep' ELSE 'suspend' END AS verdict
FROM card"""


@check(CARD_SQL)
def endpoint_scorecard_query(spark, sf_dir):
    return endpoint_scorecard(fetch_log(spark, sf_dir), expected=[404], fixed=[0])


@check(
    f"SELECT count(*) AS endpoints, CAST(count_if(verdict = 'keep') AS BIGINT) AS usable FROM ({CARD_SQL}) AS card"
)
def usable_endpoints_query(spark, sf_dir):
    return usable_endpoints(endpoint_scorecard(fetch_log(spark, sf_dir), expected=[404], fixed=[0]))
