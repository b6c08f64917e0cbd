"""Checks over orders, lineitem, customer, supplier and part: units, values, dates, joins, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, json_pages, table
from sharefold import feeds as fd
from sharefold.feeds import BASIC_INDEX, Field
from sharefold.functions import code_label, date_head, exchange_symbol, scale_ratio, share_id, to_bigint
from sharefold.operators.merge import latest_by_key
from sharefold.operators.parse import explode_units, lenient_json, nonempty_pages, project_positional
from sharefold.operators.paging import indexed_page, write_page_index
from sharefold.operators.planning import page_query
from sharefold.operators.shares import enrich_share, with_cutoff
from sharefold.operators.store import retain, stored_projection, union_pages
from sharefold.session import scratch_path
from sharefold.sinks import write_jsonl


@check("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, o_orderdate, o_orderpriority, NULL::VARCHAR AS note FROM orders")
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderdate",
        "o_orderpriority",
        F.lit(None).cast("string").alias("note"),
    )
    write_jsonl(orders, path)
    schema = "o_orderkey bigint, price double, o_orderdate timestamp_ntz, o_orderpriority string, note string"
    return spark.read.schema(schema).json(path)


@check(
    "SELECT l_partkey, ship_date, l_returnflag, l_suppkey, l_quantity FROM ("
    "SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, l_quantity, "
    "first_value(l_returnflag) OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE) "
    "ORDER BY l_orderkey, l_linenumber, l_returnflag) AS l_returnflag, "
    "row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE) "
    "ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1"
)
def upsert_collapse(spark, sf_dir):
    """Several holders (suppliers) of one share and date collapse to the last written."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("ship_date"), "l_returnflag", "l_suppkey", "l_quantity",
        "l_orderkey", "l_linenumber",
    )
    state = latest_by_key(rows, ["l_partkey", "ship_date"], ["l_returnflag"], ["l_orderkey", "l_linenumber"])
    return state.select("l_partkey", "ship_date", "l_returnflag", "l_suppkey", "l_quantity")


@check("SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM (SELECT l_partkey, l_shipdate, l_suppkey, "
       "max(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2, 3)")
def upsert_extra_key(spark, sf_dir):
    """The same with the holder in the key: nothing collapses across holders."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_suppkey", "l_linenumber")
    key = ["l_partkey", "l_shipdate", "l_suppkey"]
    state = latest_by_key(rows.withColumn("arrived", F.col("l_linenumber")), key, [], ["arrived"])
    return state.agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@check("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders")
def positional_split(spark, sf_dir):
    unit = F.concat_ws(",", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    fields = [
        Field("o_orderkey", 0, fd.COUNT),
        Field("o_custkey", 1, fd.COUNT),
        Field("o_totalprice", 2, fd.NUMBER),
        Field("o_orderpriority", 3),
        Field("day", 4),
        Field("beyond", 9),
    ]
    rows = project_positional(table(spark, sf_dir, "orders").select(unit.alias("unit")), fields)
    return rows.where(F.col("beyond").isNull()).withColumn("day", date_head("day")).drop("beyond")


def order_pages(spark, sf_dir, unit):
    orders = table(spark, sf_dir, "orders")
    return json_pages(orders, F.floor(F.col("o_orderkey") / 20), "o_orderkey", unit)


@check(
    "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) - 1 AS INT) AS unit_pos, "
    "o_totalprice FROM orders"
)
def explode_units_query(spark, sf_dir):
    pages = order_pages(spark, sf_dir, F.struct("o_orderkey", "o_totalprice"))
    body = F.concat(F.lit("{pages: 1, data: "), F.to_json("units"), F.lit("}"))
    read = pages.select(
        lenient_json(body, "data array<struct<o_orderkey: bigint, o_totalprice: double>>, pages int").alias("e")
    )
    units = explode_units(read.select(F.col("e.data").alias("units")))
    return units.select("unit.o_orderkey", "unit_pos", "unit.o_totalprice")


@check(
    "SELECT o_orderkey // 20 AS page, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1"
)
def nonempty_pages_query(spark, sf_dir):
    """Pages keep only their dear orders; those left without any vanish."""
    pages = order_pages(spark, sf_dir, F.struct("o_totalprice"))
    dear = pages.withColumn("units", F.filter("units", lambda u: u["o_totalprice"] > 300000))
    return nonempty_pages(dear).select("page", F.size("units").cast("bigint").alias("n"))


@check("SELECT o_orderkey, o_custkey FROM orders")
def explode_nested_first(spark, sf_dir):
    pages = order_pages(spark, sf_dir, F.concat_ws(",", "o_orderkey", "o_custkey"))
    body = F.concat(F.lit("{data: ["), F.to_json("units"), F.lit(", ['not', 'this']]}"))
    read = pages.select(lenient_json(body, "data array<array<string>>").alias("e"))
    units = explode_units(read.select(F.col("e.data").alias("units")), nested=True).drop("unit_pos")
    return project_positional(units, [Field("o_orderkey", 0, fd.COUNT), Field("o_custkey", 1, fd.COUNT)])


@check(
    "SELECT CAST(p_partkey AS VARCHAR) AS shares_code, p_name AS shares_name, CAST(p_size AS VARCHAR) AS shares_type, "
    "p_retailprice AS latest_price, p_retailprice * 2 AS close_price, DATE '2018-08-10' AS date FROM part"
)
def stored_projection_query(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("type"),
        F.col("p_partkey").cast("string").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("last_price"),
        (F.col("p_retailprice") * 2).alias("prev_close"),
        F.lit("2018-08-10 14:52:00").alias("last_update_time"),
    )
    missing = [f.name for f in BASIC_INDEX.fields if f.name not in part.columns]
    items = part.withColumns({name: F.lit(None).cast("double") for name in missing})
    return stored_projection(items, BASIC_INDEX).select(
        "shares_code", "shares_name", "shares_type", "latest_price", "close_price", "date"
    )


@check(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS DOUBLE) "
    "WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice * 100.0::DOUBLE END AS pct FROM orders"
)
def ratio_gated(spark, sf_dir):
    """Decimal text is scaled, whole numbers pass, other text is NULL."""
    price, status = F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.col("o_orderstatus")
    text = F.when(status == "P", F.col("o_custkey").cast("string")).when(status == "F", "None").otherwise(price)
    return table(spark, sf_dir, "orders").select("o_orderkey", scale_ratio(text, gated=True).alias("pct"))


@check("SELECT l_orderkey, l_linenumber, round(l_discount * 100, 6) AS pct FROM lineitem")
def ratio_scaled(spark, sf_dir):
    pct = F.round(scale_ratio(F.col("l_discount").cast("string")), 6)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pct.alias("pct"))


@check("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_before_space(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "orders").select("o_orderkey", date_head(text).alias("day"))


@check("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_before_t(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select("o_orderkey", date_head(text, "T").alias("day"))


@check(
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '完成实施' WHEN 'O' THEN '实施中' ELSE '未定义' END AS label "
    "FROM orders"
)
def code_label_query(spark, sf_dir):
    code = F.when(F.col("o_orderstatus") == "F", "006").when(F.col("o_orderstatus") == "O", "004").otherwise("009")
    return table(spark, sf_dir, "orders").select("o_orderkey", code_label(code).alias("label"))


@check(
    "SELECT p_partkey, CASE p_size % 3 WHEN 1 THEN 'SH' WHEN 2 THEN 'SZ' END || p_partkey AS symbol, "
    "p_partkey || '' || (p_size % 3) AS share_id FROM part"
)
def exchange_prefix(spark, sf_dir):
    kind = (F.col("p_size") % 3).cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey", exchange_symbol("p_partkey", kind).alias("symbol"), share_id("p_partkey", kind).alias("share_id")
    )


@check("SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def enrich_share_query(spark, sf_dir):
    universe = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return enrich_share(rows, universe, "o_custkey")


@check(
    "SELECT c_custkey, coalesce(max(o_orderdate), TIMESTAMP '1990-01-01') AS cutoff "
    "FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"
)
def cutoff_lookup(spark, sf_dir):
    marks = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("mark")
    )
    shares = table(spark, sf_dir, "customer").select("c_custkey")
    return with_cutoff(shares, marks, "c_custkey", "mark", F.lit("1990-01-01").cast("timestamp_ntz"))


@check("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 300 OFFSET 300")
def page_query_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_query(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], page=2, size=300)


@check(
    "(SELECT o_orderkey, o_totalprice, 'middle' AS page FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 45 OFFSET 675) UNION ALL "
    "(SELECT o_orderkey, o_totalprice, 'last' FROM orders ORDER BY o_totalprice DESC, o_orderkey "
    "LIMIT 45 OFFSET (SELECT (count(*) - 1) // 45 * 45 FROM orders))"
)
def page_deep(spark, sf_dir):
    """Numbered pages from a range index: one in the middle and the last one."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path, order = scratch_path(spark, "pages"), [F.desc("o_totalprice"), F.asc("o_orderkey")]
    write_page_index(orders, order, path, ranges=16)
    middle = indexed_page(spark, path, order, 16, 45).withColumn("page", F.lit("middle"))
    last = indexed_page(spark, path, order, -(-orders.count() // 45), 45).withColumn("page", F.lit("last"))
    return middle.unionByName(last)


@check(
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3 "
    "ORDER BY c_acctbal DESC, c_custkey LIMIT 100"
)
def page_query_filtered(spark, sf_dir):
    market = F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_nationkey") != 3)
    rows = table(spark, sf_dir, "customer").where(market).select("c_custkey", "c_acctbal")
    return page_query(rows, [F.desc("c_acctbal"), F.asc("c_custkey")], page=1, size=100)


@check(
    "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier"
)
def union_pages_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return union_pages(customer, supplier)


@check(
    "SELECT o_orderkey, o_orderdate FROM orders "
    "WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY"
)
def retention(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    newest = orders.agg(F.max("o_orderdate").cast("date").alias("d")).head().d
    return retain(orders, "o_orderdate", 365, F.lit(newest))


@check(
    "SELECT doc_id, n_chars AS whole, TRY_CAST(n_chars || '.5' AS DOUBLE) AS half, CAST(NULL AS BIGINT) AS bad "
    "FROM documents"
)
def numeric_cast(spark, sf_dir):
    text = F.col("n_chars").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        to_bigint(text).alias("whole"),
        F.concat(text, F.lit(".5")).try_cast("double").alias("half"),
        to_bigint(F.concat(F.lit("x"), text)).alias("bad"),
    )
