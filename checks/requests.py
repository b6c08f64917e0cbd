"""Checks of request addresses and request tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from sharefold.feeds import ANNOUNCEMENT, FINANCIAL_NOTICE, MAIN_INFLUX, NEWS
from sharefold.functions import query_string
from sharefold.operators.planning import explode_numbers, fetch_plan, page_plan, pages_of, pending_requests, remaining_pages
from sharefold.operators.store import union_pages

BASE = "https://feed.example/list"


@check(
    f"SELECT c_custkey, '{BASE}?symbol=' || c_custkey || '&count=20&segment=' || c_mktsegment || '&page=1' AS url FROM customer"
)
def query_string_query(spark, sf_dir):
    params = {"symbol": F.col("c_custkey"), "count": 20, "segment": F.col("c_mktsegment"), "page": 1}
    return table(spark, sf_dir, "customer").select("c_custkey", query_string(BASE, params).alias("url"))


@check(
    f"""
    WITH n AS (SELECT o_custkey, CAST(ceil(count(*) / 3.0) AS BIGINT) AS pages FROM orders GROUP BY 1)
    SELECT o_custkey, pages AS total_pages, page_no, '{BASE}?id=' || o_custkey || '&page=' || page_no AS url
    FROM (SELECT o_custkey, pages, unnest(generate_series(2, pages)) AS page_no FROM n WHERE pages >= 2)"""
)
def page_plan_query(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("rows"))
    url = query_string(BASE, {"id": F.col("o_custkey"), "page": 1})
    first = counts.select("o_custkey", pages_of(F.col("rows"), 3).alias("total_pages"), url.alias("url"))
    return page_plan(first, url="url")


@check(
    f"""
    WITH share AS (SELECT c_custkey, CASE c_nationkey % 3 WHEN 1 THEN 'SH' WHEN 2 THEN 'SZ' END AS prefix, c_nationkey % 3 AS kind FROM customer)
    SELECT 'announcement' AS feed, CAST(c_custkey AS VARCHAR) AS share_code, page_no, 20 AS page_size,
      '{BASE}?symbol_id=' || prefix || c_custkey || '&count=20&source=公告&page=' || page_no AS url
    FROM (SELECT *, unnest(generate_series(1, 2)) AS page_no FROM share)
    UNION ALL SELECT 'main_influx', CAST(c_custkey AS VARCHAR), 1, 1, '{BASE}?type=hff&rtntype=2&js={{data:[(x)]}}' ||
      '&cb=var%20aff_data=&check=C&acces_token=T&id=' || c_custkey || kind || '&_=5' FROM share
    UNION ALL SELECT 'financial_notice', CAST(c_custkey AS VARCHAR), 1, 1, '{BASE}' || c_custkey || '.html' FROM share"""
)
def fetch_plan_query(spark, sf_dir):
    shares = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("shares_code"), (F.col("c_nationkey") % 3).cast("string").alias("shares_type")
    )
    return union_pages(
        fetch_plan(shares, ANNOUNCEMENT, BASE, pages=2),
        fetch_plan(shares, MAIN_INFLUX, BASE, token="T", check="C", stamp=5),
        fetch_plan(shares, FINANCIAL_NOTICE, BASE),
    )


@check("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def pending_anti(spark, sf_dir):
    plan = table(spark, sf_dir, "customer").select("c_custkey")
    landed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return pending_requests(plan, landed, ["c_custkey"])


@check(
    "SELECT r_name, count(*) AS n, min(v) AS low, max(v) AS high FROM (SELECT r_name, unnest(generate_series(1, c)) AS v "
    "FROM (SELECT r_name, count(*) AS c FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)) GROUP BY 1"
)
def long_page_runs(spark, sf_dir):
    """Very long page runs per share: one page per line of a region."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    shares = lines.groupBy("r_name").agg(F.count(F.lit(1)).alias("c"))
    pages = explode_numbers(shares, F.lit(1), F.col("c"), "v")
    return pages.groupBy("r_name").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


@check(
    f"""
    WITH line AS (SELECT o_custkey, o_orderstatus, ceil(count(*) OVER (PARTITION BY o_custkey) / 2.0) AS total FROM orders),
    landed AS (SELECT DISTINCT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 5 END AS page_no FROM line),
    plan AS (SELECT o_custkey, unnest(generate_series(1, CAST(total AS BIGINT))) AS page_no FROM (SELECT DISTINCT o_custkey, total FROM line))
    SELECT 'news' AS feed, CAST(o_custkey AS VARCHAR) AS share_code, page_no, 20 AS page_size,
      '{BASE}?id=' || o_custkey || '&page=' || page_no AS url
    FROM plan WHERE NOT EXISTS (SELECT 1 FROM landed WHERE landed.o_custkey = plan.o_custkey AND landed.page_no = plan.page_no)"""
)
def remaining_pages_query(spark, sf_dir):
    """Landed pages announce how many there are; those not landed are asked for."""
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy("o_custkey").agg(pages_of(F.count(F.lit(1)), 2).alias("total_pages"))
    status = F.col("o_orderstatus")
    page = F.when(status == "F", 1).when(status == "O", 2).otherwise(5)
    landed = orders.select("o_custkey", page.alias("page_no")).distinct().join(counts, "o_custkey")
    url = query_string(BASE, {"id": F.col("o_custkey"), "page": F.col("page_no")})
    counters = landed.select(
        F.lit("news").alias("feed"), url.alias("url"), F.col("o_custkey").cast("string").alias("share_code"),
        "page_no", "total_pages",
    )
    return remaining_pages(counters, NEWS)
