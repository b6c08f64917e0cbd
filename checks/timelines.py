"""Checks of page bounds and of the full, period and newest-only cuts, over events as a timeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, epoch_ms, table
from sharefold.operators import incremental as inc
from sharefold.operators.shares import high_water, with_cutoff

# A run at the end of January 2024 that looks ten days back.
AS_OF_MS = 1_706_659_200_000
LOOKBACK_DAYS = 10
CUT_MS = AS_OF_MS - LOOKBACK_DAYS * inc.DAY_MS


def timeline(spark, sf_dir):
    """Events with their page: one per share and day, numbered from the newest day."""
    page = F.date_diff(F.lit("2024-02-01").cast("date"), F.to_date("ts")) + 1
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", epoch_ms("ts").alias("ms"), page.alias("page_no"))


TIMELINE_SQL = (
    "e AS (SELECT event_id, user_id, ts, epoch_us(ts) // 1000 AS ms, "
    "date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') + 1 AS page_no FROM events)"
)
PAGES_SQL = (
    "k AS (SELECT user_id, page_no, coalesce(max(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY user_id "
    "ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM b) "
    "SELECT event_id, user_id, CAST(page_no AS INT) AS page_no FROM e JOIN k USING (user_id, page_no) WHERE done = 0"
)


@check(
    "SELECT user_id, event_id // 20 AS page, coalesce(min(ms), 0) AS min_created, coalesce(max(ms), 0) AS max_created "
    "FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) // 1000 END AS ms FROM events) GROUP BY 1, 2"
)
def page_bounds(spark, sf_dir):
    created = F.when(F.col("event_type") != "error", epoch_ms("ts"))
    units = table(spark, sf_dir, "events").select(
        "user_id", F.floor(F.col("event_id") / 20).alias("page"), created.alias("ms")
    )
    return inc.page_bounds(units, "user_id", "page", "ms")


@check(f"SELECT event_id, ts FROM events WHERE epoch_us(ts) // 1000 > {CUT_MS}")
def incremental_period(spark, sf_dir):
    rows = inc.cut_rows(timeline(spark, sf_dir), "ms", inc.period_start(F.lit(AS_OF_MS), LOOKBACK_DAYS))
    return rows.select("event_id", "ts")


@check(f"WITH {TIMELINE_SQL}, b AS (SELECT user_id, page_no, min(ms) <= {CUT_MS} AS stop FROM e GROUP BY 1, 2), {PAGES_SQL}")
def incremental_pages(spark, sf_dir):
    rows = timeline(spark, sf_dir)
    bounds = inc.page_bounds(rows, "user_id", "page_no", "ms")
    stop = inc.stop_rule("period", F.lit(AS_OF_MS), LOOKBACK_DAYS)
    return inc.cut_pages(rows, bounds, "user_id", "page_no", stop).select("event_id", "user_id", "page_no")


@check(
    f"""
    WITH {TIMELINE_SQL},
    marks AS (SELECT user_id, max(CASE WHEN user_id % 5 = 0 THEN {AS_OF_MS} ELSE ms END) AS mark FROM e
              WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 3 <> 0 GROUP BY 1),
    b AS (SELECT user_id, page_no, {AS_OF_MS} <= coalesce(any_value(mark), {CUT_MS})
            OR min(ms) <= coalesce(any_value(mark), {CUT_MS}) AS stop
          FROM e LEFT JOIN marks USING (user_id) GROUP BY 1, 2), {PAGES_SQL}"""
)
def incremental_newest(spark, sf_dir):
    """A third of the shares has no mark and falls to the default cut; a fifth is up to date and gives one page."""
    rows = timeline(spark, sf_dir)
    seen = rows.where((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("user_id") % 3 != 0))
    seen = seen.withColumn("ms", F.when(F.col("user_id") % 5 == 0, F.lit(AS_OF_MS)).otherwise(F.col("ms")))
    marks = high_water(seen, "user_id", "event_id", "ms")
    now = F.lit(AS_OF_MS)
    bounds = inc.page_bounds(rows, "user_id", "page_no", "ms")
    bounds = with_cutoff(bounds, marks, "user_id", "max_at", inc.period_start(now, LOOKBACK_DAYS), salt="page_no")
    stop = inc.stop_rule("newest", now, cutoff=F.col("cutoff"))
    return inc.cut_pages(rows, bounds, "user_id", "page_no", stop).select("event_id", "user_id", "page_no")
