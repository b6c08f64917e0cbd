"""Checks of runs over several batches and feeds, and of odd values."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds import AS_OF_MS, BLOCK, NEWS_SQL, TOP_BLOCK, NEWS_STEPS, customers, landed, notice_run, positional, text, timeline_landing, utf8
from checks.registry import check, epoch_ms, json_pages, table
from sharefold.feeds import feed
from sharefold.functions import decode_body, epoch_to_bj
from sharefold.functions.text import unescape
from sharefold.operators.merge import with_arrival
from sharefold.operators.parse import lenient_json
from sharefold.operators.planning import page_after, pending_requests
from sharefold.plans import ingest, ingest_all, replay_rejects, run_metrics
from sharefold.session import scratch_path
from sharefold.sinks import merge_into_table, pin, read_stored, write_jsonl
from sharefold.sources import stream_landing
from sharefold.streaming import drop_repeats, stream_feed, stream_upsert


def early_news(spark, sf_dir, path):
    """The stored state that newest-only runs start from: some shares' first half of January."""
    events = table(spark, sf_dir, "events")
    early = (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & (F.col("user_id") % 3 != 0)
    ingest(timeline_landing(spark, sf_dir, "news", events.where(early), 1), "news", path, 1, universe=customers(spark, sf_dir))


@check(NEWS_SQL)
def newest_in_batches(spark, sf_dir):
    """One newest-only run whose pages land in three batches, some of the newest pages last; as if they had come in one."""
    path = scratch_path(spark, "news-batches")
    early_news(spark, sf_dir, path)
    pages = pin(timeline_landing(spark, sf_dir, "news", table(spark, sf_dir, "events"), 2), f"{path}/pages")
    first, last = (pages.select(bound("page_no")).scalar() for bound in (F.min, F.max))
    new = F.col("page_no") < first + (last - first) * 0.2
    late = new & (F.col("page_no") % 3 == 0)
    for batch, part in enumerate((new & ~late, ~new, late), 2):
        run = ingest(
            pages.where(part), "news", path, batch, universe=customers(spark, sf_dir),
            mode="newest", as_of_ms=AS_OF_MS, period_days=10, run_id=2,
        )
    return run.table().select("shares_code", "shares_name", "news_id", "news_title", "date")


@check(
    f"""{NEWS_STEPS}
    SELECT CAST(user_id AS VARCHAR) AS symbol, event_id AS news_id FROM e JOIN k USING (user_id, page_no) JOIN customer ON c_custkey = user_id
    WHERE done = 0"""
)
def dump_newest(spark, sf_dir):
    """The dump of a newest-only run: items of the pages it takes, and of no page beyond the cut."""
    path = scratch_path(spark, "dump-newest")
    early_news(spark, sf_dir, path)
    run = ingest(
        timeline_landing(spark, sf_dir, "news", table(spark, sf_dir, "events"), 2), "news", path, 2,
        universe=customers(spark, sf_dir), mode="newest", as_of_ms=AS_OF_MS, period_days=10,
    )
    write_jsonl(run.items(), f"{path}/dump")
    return spark.read.schema("symbol string, news_id bigint").json(f"{path}/dump")


@check(
    "SELECT CAST(p_partkey AS VARCHAR) AS symbol, '2018-08-1' || n AS announcement_date "
    "FROM part, (SELECT unnest(generate_series(0, 2)) AS n) WHERE p_size % 4 <> 0"
)
def dump_notice(spark, sf_dir):
    """The dump of notices: those without a date are not in it."""
    path = scratch_path(spark, "dump-notice")
    write_jsonl(notice_run(spark, sf_dir).items(), path)
    return spark.read.schema("symbol string, announcement_date string").json(path)


@check(
    """
    SELECT user_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS date,
      arg_min(event_type, CASE WHEN value < 50 THEN 0 ELSE 1 END * 10000000000000000 + epoch_us(ts)) AS event_type,
      arg_max(value, CASE WHEN value < 50 THEN 0 ELSE 1 END * 10000000000000000 + epoch_us(ts)) AS value
    FROM events GROUP BY ALL"""
)
def upsert_null_partition(spark, sf_dir):
    """Two batches into a table partitioned by a date that some rows lack; no stored row may go."""
    events = table(spark, sf_dir, "events")
    day = F.when(F.col("event_type") != "error", F.to_date("ts"))
    rows = events.select("user_id", day.alias("date"), "event_type", "value", "ts")
    path = scratch_path(spark, "null-partition")
    for batch, part in enumerate((F.col("value") < 50, F.col("value") >= 50)):
        arrived = with_arrival(rows.where(part), [F.lit(batch), F.col("ts")]).drop("ts")
        merge_into_table(pin(arrived, f"{path}/landed"), path, ("user_id", "date"), ("event_type",), "date")
    return read_stored(spark, path).select("user_id", "date", "event_type", "value")


@check(
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS day,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS utf8, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS gbk,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS ascii
    FROM events"""
)
def odd_values(spark, sf_dir):
    """Instants out of range and bytes that no charset knows cost their field, and never the run."""
    events = table(spark, sf_dir, "events")
    ms = F.when(F.col("event_id") % 3 == 0, F.lit(10**17) * F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)).otherwise(epoch_ms("ts"))
    torn = F.concat(F.encode("event_type", "UTF-8"), F.when(F.col("event_id") % 4 == 0, F.lit(b"\xff")).otherwise(F.lit(b"")))
    rows = events.select("event_id", ms.alias("ms"), torn.alias("body"))
    return rows.select(
        "event_id", epoch_to_bj("ms", "ms").alias("day"), decode_body("body").alias("utf8"),
        decode_body("body", "GBK").alias("gbk"), decode_body("body", "US-ASCII").alias("ascii"),
    )


@check(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CASE event_id % 7 WHEN 3 THEN 'a' || chr(9) || 'b' "
    "WHEN 4 THEN 'a,]b' WHEN 6 THEN '/*a*/' ELSE 'ab' END AS s FROM events"
)
def lenient_json_forms(spark, sf_dir):
    """One form a row: bare names, single quotes, comments, control characters, trailing commas, needless escapes."""
    k = F.get_json_object("props", "$.k")

    def form(left, right):
        return F.concat(F.lit(left), k, F.lit(right))

    n = F.col("event_id") % 7
    body = (
        F.when(n == 0, form("{k: ", ", s: 'ab'}"))
        .when(n == 1, form("{'k': ", ", 's': 'ab'}"))
        .when(n == 2, form('{/* "k": 7, */ "k": ', ', "s": "ab"}'))
        .when(n == 3, form('{"k": ', ', "s": "a\tb"}'))
        .when(n == 4, form('{"k": ', ', "s": "a,]b", }'))
        .when(n == 5, form('{"k": ', ', "s": "\\ab", "list": [1, 2,]}'))
        .otherwise(form('{"k": ', ', "s": "/*a*/"}'))
    )
    read = table(spark, sf_dir, "events").select("event_id", lenient_json(body, "k int, s string").alias("p"))
    return read.select("event_id", "p.k", "p.s")


@check(
    "SELECT event_id, '<' || event_type || '>' || chr(233) || chr(160) || chr(128512) || chr(8364) || '&amp; &nosuch; & #38;' AS t FROM events"
)
def entities(spark, sf_dir):
    """Numbered and named entities; each is read once, and what is none stays."""
    body = F.concat(F.lit("&lt;"), "event_type", F.lit("&#62;&eacute;&nbsp;&#x1F600;&#8364;&amp;amp; &nosuch; & #38;"))
    return table(spark, sf_dir, "events").select("event_id", unescape(body).alias("t"))


@check("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def pending_open(spark, sf_dir):
    plan = table(spark, sf_dir, "customer").select("c_custkey")
    landed_rows = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return pending_requests(plan, landed_rows.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@check(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 250000 OR (o_totalprice = 250000 AND o_orderkey > 7) "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 300"
)
def page_after_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_after(orders, [("o_totalprice", True), ("o_orderkey", False)], 300, after=(250000.0, 7))


def influx_landing(spark, sf_dir, batch):
    """A share's whole history in one response: a row a day; the second batch changes a single month."""
    days = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.max("o_orderkey").alias("v"))
    changed = (F.lit(batch) == 2) & (F.date_format("d", "yyyy-MM") == "1995-03")
    value = (F.col("v") + F.when(changed, 1000).otherwise(0)).cast("string")
    unit = F.concat_ws(",", F.col("d").cast("string"), value, *[F.lit(str(i)) for i in range(9)])
    histories = days.groupBy("o_custkey").agg(F.array_sort(F.collect_list(unit)).alias("units"))
    body = utf8("var aff_data={data:[", F.to_json("units"), "]}")
    arrived = F.col("o_custkey") + F.lit(batch * 100_000_000)
    return landed(histories, "main_influx", body, arrived, share=F.col("o_custkey"))


@check(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS shares_code, CAST(o_orderdate AS DATE) AS date,
      (max(o_orderkey) + CASE WHEN strftime(CAST(o_orderdate AS DATE), '%Y-%m') = '1995-03' THEN 1000 ELSE 0 END)::DOUBLE AS main_influx_price
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""
)
def influx_changes(spark, sf_dir):
    """The same histories twice with one month changed: the state is that of a full rewrite."""
    path, names = scratch_path(spark, "influx-changes"), customers(spark, sf_dir)
    for batch in (1, 2):
        landing = influx_landing(spark, sf_dir, batch)
        run = ingest(landing, "main_influx", path, batch, universe=names, only_changes=True)
    return run.table().select("shares_code", "date", "main_influx_price")


@check(
    """
    SELECT 'basic_index' AS feed, CAST(user_id AS VARCHAR) AS shares_code, count(DISTINCT CAST(ts AS DATE)) AS n FROM events GROUP BY user_id
    UNION ALL SELECT 'announcement', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id
    UNION ALL SELECT 'news', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id"""
)
def mixed_feeds(spark, sf_dir):
    """One landing of three feeds to three tables; the universe is that of the index it brings."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "mixed")
    places = {
        0: F.lit("1"), 1: text("user_id"), 2: F.col("event_type"), 3: text("value"),
        24: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }
    pages = json_pages(events, F.floor(F.col("event_id") / 20), "event_id", positional(places, 25))
    body = utf8("jQuery({data: ", F.to_json("units"), ", recordsFiltered: 20})")
    landing = landed(pages, "basic_index", body, F.col("page"))
    for feed in ("announcement", "news"):
        landing = landing.unionByName(timeline_landing(spark, sf_dir, feed, events, 1))
    landing.write.partitionBy("feed").parquet(f"{path}/landing")
    runs = ingest_all(spark.read.parquet(f"{path}/landing"), path, 1)
    parts = [
        run.table().groupBy("shares_code").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feed"), "shares_code", "n")
        for name, run in runs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def event_files(spark, sf_dir, path):
    """Events in three files, written one after another, read as a stream of a file each micro-batch."""
    events = table(spark, sf_dir, "events").withColumn("batch", (F.col("event_id") % 3).cast("int"))
    for batch in range(3):
        events.where(F.col("batch") == batch).coalesce(1).write.mode("append").parquet(f"{path}/events")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")


@check(
    """
    SELECT user_id, CAST(ts AS DATE) AS date, arg_min(event_type, event_id % 3 * 10000000000000000 + epoch_us(ts)) AS event_type,
      arg_max(value, event_id % 3 * 10000000000000000 + epoch_us(ts)) AS value
    FROM events GROUP BY 1, 2"""
)
def stream_upsert_batches(spark, sf_dir):
    """Three micro-batches into one table; the newest is the last to arrive and not the latest by its own time."""
    path = scratch_path(spark, "stream-batches")
    rows = event_files(spark, sf_dir, path).select("user_id", F.to_date("ts").alias("date"), "event_type", "value", "ts")
    query = stream_upsert(rows, f"{path}/table", f"{path}/checkpoint", ("user_id", "date"), ("event_type",), "date", order=["ts"])
    query.awaitTermination()
    return read_stored(spark, f"{path}/table").select("user_id", "date", "event_type", "value")


@check("SELECT DISTINCT user_id, CAST(date_trunc('month', ts) AS DATE) AS month FROM events")
def stream_dedup_batches(spark, sf_dir):
    """Repeats across micro-batches, most of them behind the newest time seen; each user comes out once a month."""
    path = scratch_path(spark, "stream-dedup-batches")
    rows = event_files(spark, sf_dir, path).select("user_id", F.date_trunc("month", "ts").cast("timestamp_ntz").alias("at"))
    once = drop_repeats(rows, ["user_id", "at"], "at")
    query = (
        once.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start(f"{path}/rows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("user_id", F.to_date("at").alias("month"))


# Two crawls of the news timeline that look twenty days back: the first finds what there is until mid-January.
CRAWL_DAYS = 20
CRAWLS_SQL = f"""
    WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms, {TOP_BLOCK} - event_id // {BLOCK} AS page_no FROM events JOIN customer ON c_custkey = user_id),
    e1 AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16'),
    l1 AS (SELECT user_id, min(page_no) FILTER (low <= {AS_OF_MS} - {CRAWL_DAYS} * 86400000) AS last
           FROM (SELECT user_id, page_no, min(ms) AS low FROM e1 GROUP BY 1, 2) GROUP BY 1),
    k1 AS (SELECT e1.* FROM e1 JOIN l1 USING (user_id) WHERE last IS NULL OR page_no <= last),
    marks AS (SELECT user_id, max(epoch_ms(date_trunc('minute', ts))) AS mark FROM k1 GROUP BY 1),
    l2 AS (SELECT user_id, min(page_no) FILTER (low <= coalesce(mark, {AS_OF_MS} - {CRAWL_DAYS} * 86400000)) AS last
           FROM (SELECT user_id, page_no, min(ms) AS low FROM e GROUP BY 1, 2) LEFT JOIN marks USING (user_id) GROUP BY 1),
    k2 AS (SELECT e.* FROM e JOIN l2 USING (user_id) WHERE last IS NULL OR page_no <= last)"""


def two_crawls(spark, sf_dir, path):
    """A stream over landed files of two crawls, stopped and taken up again for each part; some of a crawl's newest pages
    land last."""
    events, names = table(spark, sf_dir, "events"), pin(customers(spark, sf_dir), f"{path}/names")
    early = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for crawl, rows in ((1, early), (2, events)):
        pages = pin(timeline_landing(spark, sf_dir, "news", rows, crawl).withColumn("crawl", F.lit(crawl).cast("bigint")), f"{path}/crawl{crawl}")
        first, last = (pages.select(bound("page_no")).scalar() for bound in (F.min, F.max))
        late = (F.col("page_no") < first + (last - first) * 0.2) & (F.col("page_no") % 3 == 0)
        for part in (~late, late):
            pages.where(part).write.mode("append").parquet(f"{path}/landing")
            landing = stream_landing(spark, f"{path}/landing", "news", crawled=True)
            stream_feed(
                landing, "news", f"{path}/tables", f"{path}/checkpoint", universe=names,
                mode="newest", as_of_ms=AS_OF_MS, period_days=CRAWL_DAYS,
            ).awaitTermination()


@check(
    f"""{CRAWLS_SQL}
    SELECT CAST(user_id AS VARCHAR) AS shares_code, c_name AS shares_name, event_id AS news_id, 'title ' || event_id AS news_title,
      date_trunc('minute', ts + INTERVAL 8 HOUR) AS date
    FROM (SELECT * FROM k1 UNION SELECT * FROM k2)"""
)
def newest_two_crawls(spark, sf_dir):
    """Two newest-only crawls through one stream: as two batch runs, each cut by the marks of its own start."""
    path = scratch_path(spark, "two-crawls")
    two_crawls(spark, sf_dir, path)
    rows = read_stored(spark, f"{path}/tables/{feed('news').table}")
    return rows.select("shares_code", "shares_name", "news_id", "news_title", "date")


# A landing with an answer of every kind: fine, empty, refused by the server, torn, and of shares nobody knows.
METRICS_SQL = """
    WITH p AS (SELECT event_id // 20 AS page, user_id % 5 AS b, count(*) AS n FROM events WHERE user_id % 5 < 2 GROUP BY 1, 2),
    s AS (SELECT *, CASE page % 11 WHEN 3 THEN 'status' WHEN 5 THEN 'torn' WHEN 7 THEN 'empty' ELSE 'ok' END AS state FROM p),
    u AS (SELECT e.*, e.event_id // 20 AS page, user_id % 5 AS b FROM events e JOIN s ON s.page = e.event_id // 20 AND s.b = e.user_id % 5 AND state = 'ok'),
    k AS (SELECT user_id, CAST(ts AS DATE) AS d, b, page FROM u WHERE event_type <> 'error')
    SELECT s.b + 1 AS batch, count(*) AS pages, count(*) FILTER (state IN ('status', 'torn')) AS refetches, 0::BIGINT AS bad_shapes,
      any_value(x.units) AS units, any_value(x.accepted) AS accepted, any_value(x.rejects) AS rejects,
      any_value(y.n) AS rows_new, 0::BIGINT AS rows_changed
    FROM s JOIN (SELECT b, count(*) AS units, count(*) FILTER (event_type <> 'error') AS accepted, count(*) FILTER (event_type = 'error') AS rejects
                 FROM u GROUP BY b) x ON x.b = s.b
    JOIN (SELECT b, count(DISTINCT (user_id, d)) AS n FROM k GROUP BY b) y ON y.b = s.b GROUP BY s.b
    UNION ALL
    SELECT 3, count(*), count(*) FILTER (state IN ('status', 'torn')), 0, (SELECT count(*) FROM u WHERE b = 1),
      (SELECT count(*) FROM u WHERE b = 1 AND event_type <> 'error'), (SELECT count(*) FROM u WHERE b = 1 AND event_type = 'error'),
      0, (SELECT count(DISTINCT (user_id, d)) FROM k WHERE b = 1)
    FROM s WHERE b = 1"""


@check(METRICS_SQL)
def metrics_of_runs(spark, sf_dir):
    """What three batches say they read, refused and changed; the third repeats the second one's rows, the second runs twice."""
    path = scratch_path(spark, "metrics")
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("")
    places = {0: F.lit("1"), 1: text("user_id"), 2: F.col("event_type"), 3: text("value"), 24: day}
    events = table(spark, sf_dir, "events").withColumn("b", F.col("user_id") % 5)
    pages = json_pages(events.where("b < 2"), F.floor(F.col("event_id") / 20), "event_id", positional(places, 25), keep=("b",))
    kind = F.col("page") % 11
    units = F.when(kind == 7, F.lit("[]")).otherwise(F.to_json("units"))
    body = utf8("jQuery({data: ", units, F.when(kind == 5, "").otherwise(", recordsFiltered: 20})"))
    landing = pin(pages.select("b", "page", body.alias("body")), f"{path}/bodies")
    for batch, part in ((1, 0), (2, 1), (2, 1), (3, 1)):
        own = landed(landing.where(F.col("b") == part), "basic_index", "body", F.col("page") + batch * 10_000_000)
        failed = F.when(F.regexp_extract("url", r"page=(\d+)", 1).cast("bigint") % 10_000_000 % 11 == 3, 500).otherwise(200)
        ingest(own.withColumn("status", failed.cast("int")), "basic_index", path, batch)
    return run_metrics(spark, path, "basic_index").drop("run")


@check(
    """
    WITH r AS (SELECT user_id, event_id, value, CASE WHEN event_type = 'error' THEN DATE '2024-03-01' ELSE CAST(ts AS DATE) END AS date,
        event_type, event_type || '(' || user_id || ')' AS name FROM events WHERE event_type <> 'error' OR user_id % 2 = 0)
    SELECT CAST(user_id AS VARCHAR) AS shares_code, date, arg_min(name, user_id % 2 * 1000000000 + event_id) AS shares_name,
      arg_max(value, user_id % 2 * 1000000000 + event_id) AS latest_price
    FROM r GROUP BY user_id, date"""
)
def rejects_replayed(spark, sf_dir):
    """Two batches with rows that lack a date. The first one's rejects are mended and replayed, twice; the second one's stay."""
    path = scratch_path(spark, "replay")
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("")
    name = F.concat("event_type", F.lit("("), text("user_id"), F.lit(")"))
    places = {0: F.lit("1"), 1: text("user_id"), 2: name, 3: text("value"), 24: day}
    events = table(spark, sf_dir, "events").withColumn("b", F.col("user_id") % 2)
    pages = json_pages(events, F.floor(F.col("event_id") / 20), "event_id", positional(places, 25), keep=("b",))
    body = utf8("jQuery({data: ", F.to_json("units"), ", recordsFiltered: 20})")
    runs = [ingest(landed(pages.where(F.col("b") == b), "basic_index", body, F.col("page")), "basic_index", path, b + 1) for b in (0, 1)]
    for _ in range(2):
        replay_rejects(runs[0], mend=lambda rows: rows.withColumn("date", F.coalesce("date", F.lit("2024-03-01").cast("date"))))
    return runs[0].table().select("shares_code", "date", "shares_name", "latest_price")
