import pytest
from pyspark.sql import functions as F

from sharefold.feeds import ANNOUNCEMENT, BASIC_INDEX, FINANCIAL_NOTICE, MAIN_INFLUX, RESTRICTED_RELEASE, SHARE_PLEDGE
from sharefold.operators import planning as pl
from sharefold.operators.paging import indexed_page, write_page_index
from sharefold.operators.planning import page_query
from sharefold.operators.shares import require_shares

BASE = "https://feed.example/x"


def urls(df):
    return [r.url for r in df.orderBy("share_code", "page_no").collect()]


def test_first_requests(spark):
    values = {"callback": "cb", "token": "T", "stamp": 5}
    assert urls(pl.first_request(spark, BASIC_INDEX, BASE, **values)) == [
        f"{BASE}?cb=cb&type=CT&token=T&sty=FCOIATC&js=(%7Bdata%3A%5B(x)%5D%2CrecordsFiltered%3A(tot)%7D)"
        "&cmd=C._A&st=(ChangePercent)&sr=-1&p=1&ps=300&_=5"
    ]
    assert urls(pl.first_request(spark, SHARE_PLEDGE, BASE, **values)) == [
        f"{BASE}?pageindex=1&pagesize=200&orderby=updatedate&order=desc&jsonp_callback=var%20cb=(x)&rt=5"
    ]
    assert urls(pl.first_request(spark, RESTRICTED_RELEASE, BASE, **values)) == [
        f"{BASE}?token=T&st=ltsj&sr=-1&p=1&ps=300&type=XSJJ_NJ_PC&js=var%20cb={{pages:(tp),data:(x)}}&filter=(gpdm=)&rt=5"
    ]


def test_share_requests(spark, universe):
    plan = pl.fetch_plan(universe, ANNOUNCEMENT, BASE, pages=2)
    assert urls(plan) == [
        f"{BASE}?symbol_id={s}&count=20&source=公告&page={p}" for s in ("SZ000002", "SH600001") for p in (1, 2)
    ]
    assert urls(pl.fetch_plan(universe, FINANCIAL_NOTICE, f"{BASE}/")) == [f"{BASE}/000002.html", f"{BASE}/600001.html"]
    assert urls(pl.fetch_plan(universe, MAIN_INFLUX, BASE, token="T", stamp=5))[1].endswith("&id=6000011&_=5")
    odd = spark.createDataFrame([("9", "3")], "shares_code string, shares_type string")
    assert urls(pl.fetch_plan(odd, ANNOUNCEMENT, BASE)) == [None]
    with pytest.raises(ValueError):
        require_shares(universe.where("false"))


def test_page_plan_and_remaining_pages(spark):
    first = spark.createDataFrame([("a", 3, "u?page=1"), ("b", 1, "u?page=1"), ("c", 0, "u?page=1")], "s string, total_pages long, url string")
    assert [(r.s, r.page_no, r.url) for r in pl.page_plan(first, url="url").orderBy("page_no").collect()] == [
        ("a", 2, "u?page=2"), ("a", 3, "u?page=3"),
    ]
    landed = spark.createDataFrame(
        [("basic_index", None, 1, 700, None, "u?p=1&ps=300"), ("basic_index", None, 2, 700, None, "u?p=2&ps=300")],
        "feed string, share_code string, page_no long, total_rows long, total_pages long, url string",
    )
    (rest,) = pl.remaining_pages(landed, BASIC_INDEX).collect()
    assert (rest.page_no, rest.url, rest.share_code) == (3, "u?p=3&ps=300", None)


@pytest.mark.parametrize("span", [0, 1, pl.BLOCK, pl.BLOCK + 1, 3 * pl.BLOCK - 1])
def test_explode_numbers(spark, span):
    df = spark.createDataFrame([("x", span)], "k string, n long")
    out = pl.explode_numbers(df, F.lit(5), F.col("n") + 4, "v").agg(F.count("v"), F.min("v"), F.max("v"), F.countDistinct("v"))
    assert tuple(out.head()) == ((span, 5, span + 4, span) if span else (0, None, None, 0))


def test_fetch_classes(spark):
    rows = [
        (200, None, "accept"), (404, None, "retry"), (503, None, "switch"), (None, "TimeoutError", "switch_connection"),
        (None, "ParseError", "plain_retry"), (None, None, "switch"),
    ]
    log = spark.createDataFrame([r[:2] for r in rows], "status int, error string")
    assert [r.fetch_class for r in pl.classify_fetches(log, expected=[404]).collect()] == [r[2] for r in rows]


def test_endpoint_scorecard(spark):
    log = spark.createDataFrame(
        [("direct", 1, 503, None)]
        + [("good", i, 200, None) for i in range(3)]
        + [("new", i, 200 if i else 503, None) for i in range(19)]
        + [("some", i, 200 if i else 503, None) for i in range(20)]
        + [("old", i, 200 if i else None, None if i else "ConnectError") for i in range(200)]
        + [("oldbad", i, 200 if i else 503, None) for i in range(200)],
        "endpoint string, ts int, status int, error string",
    )
    card = pl.endpoint_scorecard(log, fixed=["direct"])
    assert {r.endpoint: r.verdict for r in card.collect()} == {
        "direct": "keep", "good": "keep", "new": "drop", "some": "suspend", "old": "keep", "oldbad": "suspend",
    }
    assert tuple(pl.usable_endpoints(card).head()) == (6, 3)


def test_progress_may_go_below_zero_on_the_last_page(spark):
    pages = spark.createDataFrame([(650, 1, 300), (650, 3, 300)], "total int, page int, size int")
    assert tuple(pl.progress(pages, "total", "page", "size").head()) == (650, 900, -250)


def test_page_query(spark):
    df = spark.range(10)
    assert [r.id for r in pl.page_query(df, [F.desc("id")], 2, 3).collect()] == [6, 5, 4]
    with pytest.raises(ValueError):
        pl.page_query(df, [F.desc("id")], 0, 3)
    plan = pl.page_query(df, [F.desc("id")], 2, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_indexed_pages_equal_plain_ones(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"), (F.col("id") % 13).alias("price"))
    rows = rows.withColumn("price", F.when(F.col("price") > 2, F.col("price")))
    order, path = [F.desc_nulls_last("price"), F.asc("id")], str(tmp_path)
    write_page_index(rows, order, path, ranges=7)
    for size in (1, 9, 250, 1000, 5000):
        for page in {1, 2, 500 // size + 1, -(-1000 // size), 2000}:
            found = [tuple(r) for r in indexed_page(spark, path, order, page, size).collect()]
            assert found == [tuple(r) for r in page_query(rows, order, page, size).collect()], (page, size)
    plan = indexed_page(spark, path, order, 50, 5)._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan.split("PartitionFilters: ")[1].split("]")[0]
    write_page_index(rows.where("false"), order, path)
    assert indexed_page(spark, path, order, 1, 5).count() == 0
    with pytest.raises(ValueError):
        indexed_page(spark, path, order, 0, 5)
    with pytest.raises(ValueError):
        write_page_index(rows.withColumnRenamed("price", "_range"), order, path)
