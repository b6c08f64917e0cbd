"""Checks of whole feeds: rows of the given tables are dressed as responses in each feed's own wire format, then
ingested; the stored table must equal what SQL makes of the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, epoch_ms, json_pages, table, text_array, wide_table
from sharefold.plans import ingest
from sharefold.session import jvm_charsets, scratch_path


def landed(pages, feed, body, arrived, page_no=1, share=None):
    """Landing rows; ``arrived`` is a number that grows with the order of arrival."""
    return pages.select(
        F.lit(feed).alias("feed"),
        F.concat(F.lit("https://feed.example/"), F.lit(feed), F.lit("?page="), arrived.cast("string")).alias("url"),
        F.timestamp_seconds(arrived).alias("fetched_at"),
        F.lit(200).alias("status"),
        (body if not isinstance(body, str) else F.col(body)).alias("body"),
        (F.lit(page_no) if isinstance(page_no, int) else page_no).cast("int").alias("page_no"),
        F.lit(20).alias("page_size"),
        (F.lit(None) if share is None else share).cast("string").alias("share_code"),
    )


def utf8(*parts):
    return F.encode(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]), "UTF-8")


def text(name):
    return F.col(name).cast("string")


def positional(places, size):
    """A comma-joined unit with the given columns at their places and fillers elsewhere."""
    return F.concat_ws(",", *[places.get(i, F.lit(f"x{i}")) for i in range(size)])


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("shares_code"), F.lit("1").alias("shares_type"), F.col("c_name").alias("shares_name")
    )


@check(
    """
    SELECT CAST(user_id AS VARCHAR) AS shares_code, CAST(ts AS DATE) AS date,
      arg_min(event_type || '(' || user_id || ')', event_id) AS shares_name,
      CAST(user_id % 2 + 1 AS VARCHAR) AS shares_type, arg_max(value, event_id) AS latest_price,
      max(event_id)::DOUBLE AS rise_fall_ratio, max(event_id)::DOUBLE + 1 AS rise_fall_price,
      max(event_id)::DOUBLE + 2 AS volumn, max(event_id)::DOUBLE + 3 AS price, max(event_id)::DOUBLE + 4 AS max_price,
      max(event_id)::DOUBLE + 5 AS min_pirce, max(event_id)::DOUBLE + 6 AS open_price,
      max(event_id)::DOUBLE + 7 AS close_price, max(event_id)::DOUBLE + 8 AS quantity_ratio,
      max(event_id)::DOUBLE + 9 AS change_volumn, max(event_id)::DOUBLE + 10 AS pe_ratio, NULL::DOUBLE AS pb_ratio
    FROM events GROUP BY user_id, CAST(ts AS DATE)"""
)
def feed_basic_index(spark, sf_dir):
    places = {
        0: (F.col("user_id") % 2 + 1).cast("string"),
        1: text("user_id"),
        2: F.concat("event_type", F.lit("("), text("user_id"), F.lit(")")),
        3: text("value"),
        17: F.lit("-"),
        24: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }
    for shift, place in enumerate((5, 4, 6, 7, 9, 10, 11, 12, 14, 15, 16)):
        places[place] = (F.col("event_id") + shift).cast("string")
    unit = positional(places, 25)
    pages = json_pages(table(spark, sf_dir, "events"), F.floor(F.col("event_id") / 20), "event_id", unit)
    body = utf8("jQuery({data: ", text_array("units"), ", recordsFiltered: 20})")
    run = ingest(landed(pages, "basic_index", body, F.col("page")), "basic_index", scratch_path(spark, "basic"), 1)
    return run.table()


@check(
    """
    WITH r AS (
      SELECT o_custkey, o_orderkey, 0 AS pos, CAST(o_orderdate AS DATE) AS d, o_totalprice AS p FROM orders
      UNION ALL SELECT o_custkey, o_orderkey, 1, CAST(o_orderdate AS DATE) - 1, o_totalprice + 1 FROM orders)
    SELECT CAST(o_custkey AS VARCHAR) AS shares_code, d AS date, any_value(c_name) AS shares_name,
      arg_max(p, o_orderkey * 2 + pos) AS main_influx_price, max(o_orderkey * 2 + pos) // 2 + 1.0::DOUBLE AS main_influx_ratio,
      max(o_orderkey * 2 + pos) // 2 + 2.0::DOUBLE AS huge_influx_price, max(o_orderkey * 2 + pos) // 2 + 3.0::DOUBLE AS huge_influx_ratio,
      max(o_orderkey * 2 + pos) // 2 + 4.0::DOUBLE AS large_influx_price, max(o_orderkey * 2 + pos) // 2 + 5.0::DOUBLE AS large_influx_ratio,
      max(o_orderkey * 2 + pos) // 2 + 6.0::DOUBLE AS middle_influx_price, max(o_orderkey * 2 + pos) // 2 + 7.0::DOUBLE AS middle_influx_ratio,
      max(o_orderkey * 2 + pos) // 2 + 8.0::DOUBLE AS small_influx_price, max(o_orderkey * 2 + pos) // 2 + 9.0::DOUBLE AS small_influx_ratio
    FROM r JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey, d"""
)
def feed_main_influx(spark, sf_dir):
    orders = wide_table(spark, sf_dir, "orders", "o_orderkey")

    def unit(day, price):
        numbers = [(F.col("o_orderkey") + i).cast("string") for i in range(1, 10)]
        return F.concat_ws(",", day, price, *numbers)

    day = F.to_date("o_orderdate")
    today = unit(day.cast("string"), text("o_totalprice"))
    before = unit(F.date_sub(day, 1).cast("string"), (F.col("o_totalprice") + 1).cast("string"))
    body = utf8("var aff_data={data:", text_array(F.array(F.array(today, before), F.array(F.lit("no"), F.lit("no")))), "}")
    landing = landed(orders, "main_influx", body, F.col("o_orderkey"), share=F.col("o_custkey"))
    path = scratch_path(spark, "influx")
    return ingest(landing, "main_influx", path, 1, universe=customers(spark, sf_dir)).table()


def notice_run(spark, sf_dir):
    """A page per part: rows with one, two and no spans and one without a date; every fourth size lacks a header."""

    def span(*parts):
        return F.concat(F.lit("<span>"), *parts, F.lit("</span>"))

    size = F.col("p_size")
    one = span(size.cast("string"), F.lit("%"))
    two = F.concat(one, F.lit("~"), span((size + 1).cast("string"), F.lit("%")))
    rows = []
    for increase, date in ((one, "10"), (two, "11"), (F.lit(""), "12"), (one, None)):
        dated = span(F.lit(f"2018-08-{date}")) if date else F.lit("")
        cells = [F.lit("1"), span(F.col("p_type")), F.col("p_brand"), increase, F.lit("why"), span(F.lit("k")), span(F.lit("9")), dated]
        rows += [F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>")]
    heads = F.repeat(F.lit("<th>h</th>"), F.when(size % 4 == 0, 7).otherwise(8))
    body = utf8('<table id="Table2"><thead><tr>', heads, "</tr></thead><tbody>", F.concat(*rows), "</tbody></table>")
    part = wide_table(spark, sf_dir, "part", "p_partkey")
    universe = part.select(F.col("p_partkey").alias("shares_code"), F.col("p_name").alias("shares_name"))
    landing = landed(part, "financial_notice", body, F.col("p_partkey"), share=F.col("p_partkey"))
    return ingest(landing, "financial_notice", scratch_path(spark, "notice"), 1, universe=universe)


@check(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS shares_code, p_name AS shares_name, p_type AS performance_change,
      p_brand AS expected_net_profit_left, '' AS expected_net_profit_right,
      CASE n WHEN 0 THEN p_size || '%' WHEN 1 THEN p_size + 1 || '%' ELSE '' END AS performance_change_ratio_left,
      '' AS performance_change_ratio_right, 'k' AS preview_type, '9' AS previous_year_profit, 'why' AS performance_change_reason, DATE '2018-08-10' + CAST(n AS INT) AS announcement_date
    FROM part, (SELECT unnest(generate_series(0, 2)) AS n) WHERE p_size % 4 <> 0"""
)
def feed_financial_notice(spark, sf_dir):
    return notice_run(spark, sf_dir).table()


@check(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS shares_code, CAST(o_orderdate AS DATE) AS announcement_date,
      arg_min('股份' || o_orderstatus, o_orderkey) AS shares_name, arg_max('股东' || o_orderkey, o_orderkey) AS shareholders_name,
      CASE arg_max(o_orderstatus, o_orderkey) WHEN 'F' THEN '减持' ELSE '增持' END AS change_type,
      arg_max(o_totalprice, o_orderkey) AS change_share, max(o_orderkey)::DOUBLE AS change_equity_ratio,
      max(o_orderkey)::DOUBLE + 7 AS change_share_ratio, max(o_orderkey)::DOUBLE + 9 AS total_hold,
      max(o_orderkey)::DOUBLE + 10 AS total_equity_ratio, max(o_orderkey)::DOUBLE + 11 AS total_share,
      max(o_orderkey)::DOUBLE + 12 AS total_share_ratio, CAST(o_orderdate AS DATE) - 1 AS begin_date, CAST(o_orderdate AS DATE) + 2 AS end_date
    FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""
)
def feed_shareholder_change(spark, sf_dir):
    day = F.to_date("o_orderdate")
    places = {
        0: text("o_custkey"),
        1: F.concat(F.lit("股份"), "o_orderstatus"),
        4: F.concat(F.lit("股东"), text("o_orderkey")),
        5: F.when(F.col("o_orderstatus") == "F", "减持").otherwise("增持"),
        6: text("o_totalprice"),
        **{place: (F.col("o_orderkey") + place).cast("string") for place in (7, 9, 10, 11, 12)},
        13: F.date_sub(day, 1).cast("string"),
        14: F.date_add(day, 2).cast("string"),
        15: day.cast("string"),
        16: text("o_orderkey"),
    }
    unit = positional(places, 17)
    pages = json_pages(table(spark, sf_dir, "orders"), F.floor(F.col("o_orderkey") / 20), "o_orderkey", unit)
    body = F.encode(F.concat(F.lit("var x={data:"), text_array("units"), F.lit(",pages:9}")), "GBK")
    with jvm_charsets(spark, replace=False):
        landing = landed(pages, "shareholder_change", body, F.col("page"))
    return ingest(landing, "shareholder_change", scratch_path(spark, "holder"), 1).table()


def numbered(base, *keys):
    """Fields with different numbers, so that no two of them can be taken for each other."""
    return [(F.col(base) + i).alias(key) for i, key in enumerate(keys, 1)]


def object_pages(units, page, order, unit):
    pages = json_pages(units, page, order, unit)
    return pages, utf8("var x=", "{pages: 9, data: ", F.to_json("units"), "}")


@check(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS shares_code, CAST(o_orderdate + INTERVAL 8 HOUR AS DATE) AS announcement_date,
      arg_min(o_orderpriority, o_orderkey) AS shares_name, arg_max(o_totalprice, o_orderkey) AS close_price,
      CASE WHEN arg_max(o_orderstatus, o_orderkey) = 'P' THEN DATE '1970-01-01'
        ELSE CAST(o_orderdate + INTERVAL 8 HOUR AS DATE) END AS begin_date,
      max(o_orderkey) + 1.0::DOUBLE AS buyback_price_range_left, max(o_orderkey) + 2.0::DOUBLE AS buyback_price_range_right,
      max(o_orderkey) + 3.0::DOUBLE AS buyback_volumn_range_left, max(o_orderkey) + 4.0::DOUBLE AS buyback_volumn_range_right,
      max(o_orderkey) + 5.0::DOUBLE AS share_ratio_left, max(o_orderkey) + 6.0::DOUBLE AS share_ratio_right,
      max(o_orderkey) + 7.0::DOUBLE AS equity_ratio_left, max(o_orderkey) + 8.0::DOUBLE AS equity_ratio_right,
      max(o_orderkey) + 9.0::DOUBLE AS buyback_amount_range_left, max(o_orderkey) + 10.0::DOUBLE AS buyback_amount_range_right,
      CASE arg_max(o_orderstatus, o_orderkey) WHEN 'F' THEN '完成实施' WHEN 'O' THEN '实施中' ELSE '未定义' END AS impl_progress
    FROM orders GROUP BY o_custkey, o_orderdate"""
)
def feed_share_buyback(spark, sf_dir):
    status, day = F.col("o_orderstatus"), epoch_ms("o_orderdate")
    unit = F.struct(
        text("o_custkey").alias("dim_scode"),
        F.col("o_orderpriority").alias("securityshortname"),
        F.col("o_totalprice").alias("cprice"),
        F.when(status == "F", "006").when(status == "O", "004").otherwise("777").alias("repurprogress"),
        *numbered(
            "o_orderkey", "repurpricelower", "repurpricecap", "repurnumlower", "repurnumcap", "ltszxx", "ltszsx", "zszxx", "zszsx",
            "repuramountlower", "repuramountlimit",
        ),
        F.when(status != "P", day).alias("repurstartdate"),
        day.alias("dim_tradedate"),
    )
    orders = table(spark, sf_dir, "orders")
    pages, body = object_pages(orders, F.floor(F.col("o_orderkey") / 20), "o_orderkey", unit)
    landing = landed(pages, "share_buyback", body, F.col("page"))
    return ingest(landing, "share_buyback", scratch_path(spark, "buyback"), 1).table()


@check(
    """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC,
        CAST(l_suppkey AS VARCHAR) DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC) AS rn FROM lineitem)
    SELECT CAST(l_partkey AS VARCHAR) AS shares_code, CAST(l_shipdate + INTERVAL 8 HOUR AS DATE) AS update_date,
      'part ' || l_partkey AS shares_name, CAST(l_suppkey AS VARCHAR) AS shareholders_name, CAST(l_quantity AS BIGINT) AS pledge_number,
      l_extendedprice AS pledge_volumn, round(l_discount * 100, 6) AS share_ratio, l_orderkey + 1.0::DOUBLE AS pledge_price,
      l_orderkey + 2.0::DOUBLE AS equity_datio, l_orderkey + 3.0::DOUBLE AS close_position_range_left,
      l_orderkey + 4.0::DOUBLE AS close_position_range_right, l_orderkey + 5.0::DOUBLE AS warning_position_range_left,
      l_orderkey + 6.0::DOUBLE AS warning_position_range_right
    FROM r WHERE rn = 1"""
)
def feed_share_pledge(spark, sf_dir):
    """One unit a page; several holders of a share and day collapse to the last one."""
    unit = F.struct(
        text("l_partkey").alias("scode"),
        F.concat(F.lit("part "), text("l_partkey")).alias("sname"),
        text("l_suppkey").alias("gd_name"),
        F.col("l_quantity").cast("bigint").alias("new_zy_count"),
        F.col("l_extendedprice").alias("amtsharefrozen"),
        F.col("l_discount").alias("zb"),
        *numbered("l_orderkey", "sz", "zzb", "pcx_minvalue", "pcx_maxvalue", "yjx_minvalue", "yjx_maxvalue"),
        epoch_ms("l_shipdate").alias("updatedate"),
    )
    body = utf8("var x=", "{pages: 9, data: [", F.to_json(unit), "]}")
    lines = wide_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    landing = landed(lines, "share_pledge", body, F.col("l_orderkey"), page_no=F.col("l_linenumber"))
    run = ingest(landing, "share_pledge", scratch_path(spark, "pledge"), 1)
    return run.table().withColumn("share_ratio", F.round("share_ratio", 6))


@check(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS shares_code, CAST(o_orderdate AS DATE) AS circulation_date,
      arg_min(o_orderpriority, o_orderkey) AS shares_name, max(o_orderkey) AS shareholders_num,
      round(arg_max(o_totalprice / 1e9 * CASE WHEN o_totalprice / 1e9 >= 1e-4 THEN 100 ELSE 1 END, o_orderkey), 12) AS equity_ratio,
      CASE WHEN arg_max(o_orderstatus, o_orderkey) = 'P' THEN arg_max(o_custkey, o_orderkey)::DOUBLE
        ELSE round(arg_max(o_totalprice, o_orderkey) * 100, 6) END AS share_ratio,
      max(o_orderkey) + 1.0::DOUBLE AS share_num, max(o_orderkey) + 2.0::DOUBLE AS real_share_num, max(o_orderkey) + 3.0::DOUBLE AS non_share_num,
      max(o_orderkey) + 4.0::DOUBLE AS real_share_price, max(o_orderkey) + 5.0::DOUBLE AS close_price,
      'type ' || max(o_orderkey) AS share_type, max(o_orderkey) + 6.0::DOUBLE AS before_range, max(o_orderkey) + 7.0::DOUBLE AS after_range
    FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""
)
def feed_restricted_release(spark, sf_dir):
    """Ratios as JSON numbers: fractions from 1e-4 on are scaled, smaller ones and whole numbers are not."""
    status = F.col("o_orderstatus")
    share = F.when(status == "P", text("o_custkey")).otherwise(text("o_totalprice"))
    parts = [
        '{gpdm: "', text("o_custkey"), '", sname: "', F.col("o_orderpriority"),
        '", ltsj: "', F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), '", gpcjjgds: ', text("o_orderkey"),
        ", zzb: ", (F.col("o_totalprice") / F.lit(1e9)).cast("string"), ", zb: ", share, ', xsglx: "type ', text("o_orderkey"), '"',
        *[part for i, key in enumerate(("jjsl", "kjjsl", "wltsl", "jjsz", "newPrice", "jjqesrzdf", "jjhesrzdf"), 1)
          for part in (f", {key}: ", (F.col("o_orderkey") + i).cast("string"))],
        "}",
    ]
    unit = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    orders = table(spark, sf_dir, "orders")
    pages = json_pages(orders, F.floor(F.col("o_orderkey") / 20), "o_orderkey", unit)
    body = utf8("var x=", "{pages: 9, data: [", F.concat_ws(",", "units"), "]}")
    landing = landed(pages, "restricted_release", body, F.col("page"))
    run = ingest(landing, "restricted_release", scratch_path(spark, "restricted"), 1)
    return run.table().withColumns({"equity_ratio": F.round("equity_ratio", 12), "share_ratio": F.round("share_ratio", 6)})


BLOCK = 200  # ids of one page are taken from a block of this many
TOP_BLOCK = 100_000_000


def timeline_landing(spark, sf_dir, feed, rows, arrived):
    """Events as timeline pages, newest first: a page holds a share's events of one block of ids."""
    linked = F.concat(F.lit("see "), "event_type", F.lit(' <a href="/e/'), text("event_id"), F.lit('?a=1&amp;b=2">more</a> end'))
    unit = F.struct(
        F.col("event_id").alias("id"),
        epoch_ms("ts").alias("created_at"),
        F.concat(F.lit("title "), text("event_id")).alias("title"),
        F.when(F.col("event_type") == "error", F.lit("plain")).otherwise(linked).alias("description"),
    )
    block = F.floor(F.col("event_id") / BLOCK)
    pages = json_pages(rows, block, "event_id", unit, keep=("user_id",))
    body = utf8('{"page": 1, "maxPage": 9, "count": 20, "list": ', F.to_json("units"), "}")
    page_no = F.lit(TOP_BLOCK) - F.col("page")
    return landed(pages, feed, body, F.lit(arrived).cast("bigint"), page_no=page_no, share=F.col("user_id"))


@check(
    """
    SELECT CAST(user_id AS VARCHAR) AS shares_code, c_name AS shares_name, event_id AS announce_id,
      CASE WHEN event_type = 'error' THEN 'plain' ELSE 'see ' || event_type || ' ' END AS announce_title,
      CASE WHEN event_type = 'error' THEN '' ELSE '/e/' || event_id || '?a=1&b=2' END AS announce_url, '' AS announce_type,
      date_trunc('minute', ts + INTERVAL 8 HOUR) AS announce_date
    FROM events JOIN customer ON c_custkey = user_id"""
)
def feed_announcement(spark, sf_dir):
    """Full mode; every page is delivered twice and must count once."""
    landing = timeline_landing(spark, sf_dir, "announcement", table(spark, sf_dir, "events"), 1)
    again = landing.withColumn("fetched_at", F.timestamp_seconds(F.lit(2)))
    path = scratch_path(spark, "announcement")
    run = ingest(landing.unionByName(again), "announcement", path, 1, universe=customers(spark, sf_dir))
    return run.table()


AS_OF_MS = 1_706_659_200_000


NEWS_STEPS = f"""
    WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms, {TOP_BLOCK} - event_id // {BLOCK} AS page_no FROM events),
    first_run AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16' AND user_id % 3 <> 0),
    marks AS (SELECT user_id, max(epoch_ms(date_trunc('minute', ts))) AS mark FROM first_run GROUP BY 1),
    b AS (SELECT user_id, page_no, min(ms) <= coalesce(any_value(mark), {AS_OF_MS} - 10 * 86400000) AS stop
          FROM e LEFT JOIN marks USING (user_id) GROUP BY 1, 2),
    k AS (SELECT user_id, page_no, coalesce(max(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
            ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM b)"""

NEWS_SQL = f"""{NEWS_STEPS},
    kept AS (SELECT event_id FROM first_run UNION SELECT event_id FROM e JOIN k USING (user_id, page_no) WHERE done = 0)
    SELECT CAST(user_id AS VARCHAR) AS shares_code, c_name AS shares_name, event_id AS news_id, 'title ' || event_id AS news_title,
      date_trunc('minute', ts + INTERVAL 8 HOUR) AS date
    FROM kept JOIN events USING (event_id) JOIN customer ON c_custkey = user_id"""


@check(NEWS_SQL)
def feed_news(spark, sf_dir):
    """A full run over some shares' first half of January, then a newest-only run over everything."""
    events, path, names = table(spark, sf_dir, "events"), scratch_path(spark, "news"), customers(spark, sf_dir)
    early = (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & (F.col("user_id") % 3 != 0)
    ingest(timeline_landing(spark, sf_dir, "news", events.where(early), 1), "news", path, 1, universe=names)
    run = ingest(
        timeline_landing(spark, sf_dir, "news", events, 2), "news", path, 2, universe=names,
        mode="newest", as_of_ms=AS_OF_MS, period_days=10,
    )
    return run.table().select("shares_code", "shares_name", "news_id", "news_title", "date")
