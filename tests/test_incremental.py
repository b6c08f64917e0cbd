import json

import pytest
from pyspark.sql import functions as F

from sharefold.operators import incremental as inc
from sharefold.operators.lookup import look_up
from sharefold.plans import ingest, ingest_all


def kept(spark, pages, stop, cutoff=None):
    """Pages kept of share ``s`` whose pages have these oldest times (None for an empty page)."""
    rows = [("s", i + 1, t) for i, t in enumerate(pages)]
    df = spark.createDataFrame(rows, "share string, page int, at bigint")
    bounds = inc.page_bounds(df, "share", "page", "at")
    if cutoff is not None:
        bounds = bounds.withColumn("cutoff", F.lit(cutoff))
    out = inc.cut_pages(df, bounds, "share", "page", stop)
    return sorted(r.page for r in out.collect())


def test_walk_ends_on_the_first_page_at_or_below_the_cut(spark):
    stop = inc.stop_rule("newest", F.lit(100), cutoff=F.lit(35))
    assert kept(spark, [50, 40, 30, 20], stop) == [1, 2, 3]
    assert kept(spark, [50, 35, 34], stop) == [1, 2]
    assert kept(spark, [50, 40], stop) == [1, 2]


def test_up_to_date_share_gives_one_page(spark):
    stop = inc.stop_rule("newest", F.lit(35), cutoff=F.lit(35))
    assert kept(spark, [50, 40, 30], stop) == [1]


def test_empty_page_ends_the_walk(spark):
    stop = inc.stop_rule("newest", F.lit(100), cutoff=F.lit(35))
    assert kept(spark, [50, None, 40], stop) == [1, 2]


def test_period(spark):
    day = inc.DAY_MS
    stop = inc.stop_rule("period", F.lit(100 * day))
    assert kept(spark, [50 * day, 10 * day + 1, 10 * day, 5 * day], stop) == [1, 2, 3]


def test_all(spark):
    assert kept(spark, [50, 0, 3], inc.stop_rule("all", F.lit(1))) == [1, 2, 3]


def test_modes(spark):
    assert inc.cut_mode("Newest") == inc.NEWEST
    for bad in (None, "", "latest"):
        with pytest.raises(ValueError):
            inc.cut_mode(bad)
    with pytest.raises(ValueError):
        inc.stop_rule("newest", F.lit(1))


def page(number, *times):
    units = [{"id": t, "created_at": t * inc.DAY_MS, "description": "d"} for t in times]
    return json.dumps({"page": number, "maxPage": 9, "count": 20, "list": units})


def stored_ids(run):
    return sorted(r.announce_id for r in run.table().collect())


def test_runs_of_a_timeline(spark, landing, universe, tmp_path):
    now = 200 * inc.DAY_MS
    pages = landing(
        ("announcement", page(1, 199, 198), {"share_code": "600001", "page_no": 1}),
        ("announcement", page(2, 150, 109), {"share_code": "600001", "page_no": 2}),
        ("announcement", page(3, 108, 100), {"share_code": "600001", "page_no": 3}),
        ("announcement", page(1, 50, 49), {"share_code": "000002", "page_no": 1}),
        ("announcement", page(2, 48), {"share_code": "000002", "page_no": 2}),
    )

    def run(mode, root, batch, rows=pages):
        return ingest(rows, "announcement", str(tmp_path / root), batch, universe=universe, mode=mode, as_of_ms=now)

    assert stored_ids(run("all", "all", 1)) == [48, 49, 50, 100, 108, 109, 150, 198, 199]
    # 200 - 90 = 110: page 2 of the first share reaches it and is the last one taken; all its rows come along.
    assert stored_ids(run("period", "period", 1)) == [49, 50, 109, 150, 198, 199]
    assert stored_ids(run("newest", "newest", 1)) == [49, 50, 109, 150, 198, 199]
    # A second run takes page 1 of each share, and of the first share the page that reaches its mark.
    newer = landing(
        ("announcement", page(1, 205, 201), {"share_code": "600001", "page_no": 1}),
        ("announcement", page(2, 200, 199), {"share_code": "600001", "page_no": 2}),
        ("announcement", page(3, 150, 149), {"share_code": "600001", "page_no": 3}),
    )
    late = ingest(
        newer, "announcement", str(tmp_path / "newest"), 2, universe=universe, mode="newest", as_of_ms=206 * inc.DAY_MS
    )
    assert stored_ids(late) == [49, 50, 109, 150, 198, 199, 200, 201, 205]


def test_a_run_in_several_batches_loses_nothing(spark, landing, universe, tmp_path):
    root = str(tmp_path / "r")

    def pages(*numbered):
        return landing(*[("announcement", page(n, *t), {"share_code": "600001", "page_no": n}) for n, t in numbered])

    def run(batch, run_id, *numbered):
        return ingest(pages(*numbered), "announcement", root, batch, universe=universe, mode="newest", as_of_ms=140 * inc.DAY_MS, run_id=run_id)

    assert stored_ids(run(1, 1, (1, (100, 99)))) == [99, 100]
    run(2, 2, (1, (130, 129)))
    run(3, 2, (3, (126, 125)), (4, (124, 100)), (5, (98, 97)))
    last = run(4, 2, (2, (128, 127)))
    assert stored_ids(last) == [99, 100, *range(124, 131)]
    # Only pages of the batch that the run takes are given out.
    assert sorted(int(r.announce_id) for r in last.items().select("announce_id").collect()) == [127, 128]
    assert stored_ids(run(3, 2, (3, (126, 125)), (4, (124, 100)), (5, (98, 97)))) == [99, 100, *range(124, 131)]


def test_one_busy_share_keeps_every_row(spark):
    busy = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("s"), F.col("id") % 97)).alias("share"),
        (F.col("id") / 20).cast("int").alias("page"),
        (50_000 - F.col("id")).alias("at"),
    )
    bounds = inc.page_bounds(busy, "share", "page", "at")
    out = inc.cut_pages(busy, bounds, "share", "page", F.col("min_created") <= 10_000)
    per = {r.share: r["count"] for r in out.groupBy("share").count().collect()}
    rows = [(r.share, r.page, r["at"]) for r in busy.collect()]
    lows = {}
    for s, p, t in rows:
        lows[s, p] = min(t, lows.get((s, p), t))
    ends = {}
    for (s, p), low in lows.items():
        if low <= 10_000:
            ends[s] = min(p, ends.get(s, p))
    want = {}
    for s, p, _ in rows:
        if s not in ends or p <= ends[s]:
            want[s] = want.get(s, 0) + 1
    assert per == want


def test_salted_look_up_equals_the_plain_one(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("share"), F.col("id").alias("page"))
    small = spark.createDataFrame([(s, s * 10) for s in range(5)], "share long, mark long")
    for how in ("left", "inner"):
        plain = look_up(rows, small, "share", how)
        salted = look_up(rows, small, "share", how, salt="page")
        assert plain.columns == salted.columns
        assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_all_feeds_need_a_universe_and_older_batches_are_refused(spark, tmp_path):
    columns = "feed string, url string, fetched_at timestamp_ntz, status int, body binary, page_no int, page_size int, share_code string"
    body = b'var x={data:[["2018-08-01,5,1,2,3,4,5,6,7,8,9"]]}'
    landing = spark.createDataFrame([("main_influx", "u", None, 200, body, 1, 1, "7"), ("unknown", "u", None, 200, body, 1, 1, "7")], columns)
    with pytest.raises(ValueError, match="universe"):
        ingest_all(landing, str(tmp_path), 1)
    names = spark.createDataFrame([("7", "name")], "shares_code string, shares_name string")
    options = {"main_influx": {"only_changes": True}}
    for batch in (5, 5, 6):
        runs = ingest_all(landing, str(tmp_path), batch, names, options)
        assert list(runs) == ["main_influx"] and runs["main_influx"].table().count() == 1
    with pytest.raises(ValueError, match="in order"):
        ingest_all(landing, str(tmp_path), 5, names, options)
    assert ingest_all(landing.where("false"), str(tmp_path), 7) == {}
