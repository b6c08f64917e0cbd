"""Every feed from a hand-written body to its stored row; all values are invented."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from sharefold.feeds import FEEDS, feed
from sharefold.operators.parse import OK, REFETCH, parse_envelope, parse_feed, split_corrupt
from sharefold.operators.shares import share_universe
from sharefold.plans import ingest, ingest_all


def positions(n, **values):
    parts = [f"x{i}" for i in range(n)]
    for key, value in values.items():
        parts[int(key[1:])] = str(value)
    return ",".join(parts)


GRID_UNIT = positions(
    25, p0=1, p1="600001", p2="A(B)", p3=10.5, p4=0.5, p5=5.0, p6=100, p7=1000, p9=11, p10=9, p11=10, p12=10,
    p14=1.2, p15="-", p16=20, p17=2, p23="1999-11-10", p24="2018-08-10 14:52:00",
)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_specs_are_consistent():
    assert len(FEEDS) == 9
    sizes = {n: len(s.fields) for n, s in FEEDS.items()}
    assert sizes == {
        "basic_index": 18, "main_influx": 13, "financial_notice": 11, "shareholder_change": 14, "share_buyback": 17,
        "share_pledge": 13, "restricted_release": 14, "announcement": 7, "news": 7,
    }
    for spec in FEEDS.values():
        items = {f.name for f in spec.fields}
        assert {s.item for s in spec.stored} <= items
        assert set(spec.key) | set(spec.sticky) <= set(spec.columns)
    with pytest.raises(ValueError):
        feed("bonds")


def test_basic_index(spark, landing, tmp_path):
    body = 'jQuery({data: ["%s"], recordsFiltered: 1})' % GRID_UNIT
    run = ingest(landing(("basic_index", body, {})), "basic_index", str(tmp_path), 1)
    row = rows(run.table())[0]
    assert row["shares_code"] == "600001" and row["shares_name"] == "A(B)" and row["shares_type"] == "1"
    assert (row["latest_price"], row["rise_fall_ratio"], row["rise_fall_price"]) == (10.5, 5.0, 0.5)
    assert (row["max_price"], row["min_pirce"], row["close_price"]) == (11.0, 9.0, 10.0)
    assert row["change_volumn"] is None  # "-" is no number
    assert row["date"] == dt.date(2018, 8, 10)
    assert rows(run.counters())[0]["total_rows"] == 1
    assert rows(run.items())[0]["market_begin_time"] == "1999-11-10"


def test_main_influx(spark, landing, universe, tmp_path):
    body = 'var aff_data={data:[["2018-08-10,1.0,2.0,3,4,5,6,7,8,9,10","2018-08-09,-1,2,3,4,5,6,7,8,9,10"],["no"]]}'
    pages = landing(
        ("main_influx", body, {"share_code": "600001"}),
        ("main_influx", "var aff_data={data:[]}", {"share_code": "000002"}),
        ("main_influx", body, {"share_code": "999999"}),
    )
    run = ingest(pages, "main_influx", str(tmp_path), 1, universe=universe)
    got = {str(r["date"]): r for r in rows(run.table())}
    assert set(got) == {"2018-08-10", "2018-08-09"}
    assert got["2018-08-10"]["shares_name"] == "AAA" and got["2018-08-10"]["small_influx_ratio"] == 10.0
    assert [r["reject_reason"] for r in rows(run.rejects())] == ["share unknown"] * 2


NOTICE = """<html><body><table id="Table2"><thead><tr>{heads}</tr></thead><tbody>{rows}</tbody></table></body></html>"""


def notice_row(increase, date="<span>2018-08-10</span>"):
    return (
        "<tr><td>1</td><td><span>up &amp; away</span></td><td>100<b>x</b></td>"
        f"<td>{increase}</td><td><i>no</i>because</td><td><span>plan</span></td><td><span>90</span></td><td>{date}</td></tr>"
    )


def test_financial_notice(spark, landing, universe, tmp_path):
    heads = "<th>h</th>" * 8
    cells = [
        notice_row("<span>10%</span>"),
        notice_row("<span>10%</span>~<span>20%</span>", "<span>2018-08-11</span>"),
        notice_row("", "<span>2018-08-12</span>"),
        notice_row("<span>10%</span>", ""),
    ]
    pages = landing(
        ("financial_notice", NOTICE.format(heads=heads, rows="".join(cells)), {"share_code": "600001"}),
        ("financial_notice", NOTICE.format(heads="<th>h</th>" * 7, rows=cells[0]), {"share_code": "000002"}),
    )
    run = ingest(pages, "financial_notice", str(tmp_path), 1, universe=universe)
    got = {str(r["announcement_date"]): r for r in rows(run.table())}
    assert {d: r["performance_change_ratio_left"] for d, r in got.items()} == {
        "2018-08-10": "10%", "2018-08-11": "20%", "2018-08-12": "",
    }
    row = got["2018-08-10"]
    assert row["performance_change"] == "up & away" and row["expected_net_profit_left"] == "100"
    assert row["performance_change_reason"] == "because" and row["performance_change_ratio_right"] == ""
    assert [(r["share_code"], r["page_state"]) for r in rows(run.refetch())] == [("000002", "bad_shape")]
    assert rows(run.rejects()) == []


def test_shareholder_change_in_gbk(spark, landing, tmp_path):
    def unit(holder):
        return positions(
            17, p0="600001", p1="浦发", p4=holder, p5="增持", p6=5, p7=0.1, p9=50, p10=1, p11=40, p12=2,
            p13="2018-08-01", p14="2018-08-02", p15="2018-08-10", p16=0.3,
        )

    body = ('var x={data:["%s","%s","600001,short"],pages:7}' % (unit("甲"), unit("乙"))).encode("gbk")
    page = landing(("shareholder_change", body, {}))
    run = ingest(page, "shareholder_change", str(tmp_path / "a"), 1)
    (row,) = rows(run.table())
    assert row["shareholders_name"] == "乙" and row["shares_name"] == "浦发" and row["change_type"] == "增持"
    assert row["change_equity_ratio"] == 0.3 and row["begin_date"] == dt.date(2018, 8, 1)
    assert [r["reject_reason"] for r in rows(run.rejects())] == ["announcement_date missing"]
    assert rows(run.counters())[0]["total_pages"] == 7
    split = ingest(page, "shareholder_change", str(tmp_path / "b"), 1, extra_keys=("shareholders_name",))
    assert {r["shareholders_name"] for r in rows(split.table())} == {"甲", "乙"}


def test_share_buyback(spark, landing, tmp_path):
    unit = {
        "dim_scode": "600001", "securityshortname": "AAA", "newprice": 9.9, "repurpricelower": None,
        "repurpricecap": 12, "cprice": 10.1, "repurnumlower": 1e7, "repurnumcap": 2e7, "ltszxx": 0.5, "ltszsx": 1,
        "zszxx": 0.4, "zszsx": 0.9, "repuramountlower": "-", "repuramountlimit": 123456789, "repurprogress": "004",
        "repurstartdate": None, "dim_tradedate": 1533883920000,
    }
    body = "var x=" + json.dumps({"pages": 2, "data": [unit]})
    run = ingest(landing(("share_buyback", body, {})), "share_buyback", str(tmp_path), 1)
    (row,) = rows(run.table())
    assert row["impl_progress"] == "实施中" and row["announcement_date"] == dt.date(2018, 8, 10)
    assert row["begin_date"] == dt.date(1970, 1, 1)
    assert row["buyback_price_range_left"] is None and row["buyback_amount_range_left"] is None
    assert row["buyback_volumn_range_left"] == 1e7 and row["buyback_amount_range_right"] == 123456789.0
    (item,) = rows(run.parsed())
    assert item["begin_date_is_missing"] and not item["announcement_date_is_missing"]
    assert item["begin_date"] == "1970-01-01 08:00:00" and item["new_price"] == 9.9


def test_share_pledge(spark, landing, tmp_path):
    unit = {
        "scode": "600001", "sname": "AAA", "gd_name": "h", "new_zy_count": 3, "amtsharefrozen": 10.0, "sz": 20.0,
        "zb": 0.5, "zzb": 1.5, "pcx_minvalue": 1, "pcx_maxvalue": 2, "yjx_minvalue": 3, "yjx_maxvalue": 4,
        "updatedate": 1533883920000,
    }
    none = {**unit, "scode": "600002", "zb": None}
    body = "var x=" + json.dumps({"pages": 1, "data": [unit, none]})
    run = ingest(landing(("share_pledge", body, {})), "share_pledge", str(tmp_path), 1)
    got = {r["shares_code"]: r for r in rows(run.table())}
    assert got["600001"]["share_ratio"] == 50.0 and got["600001"]["pledge_number"] == 3
    assert got["600002"]["share_ratio"] is None and got["600002"]["equity_datio"] == 1.5


def test_only_rejects_are_written_beside_the_parsed_rows(spark, landing, tmp_path):
    unit = {"scode": "600001", "sname": "AAA", "updatedate": 1533883920000}
    body = "var x=" + json.dumps({"pages": 1, "data": [unit, {**unit, "scode": None}]})
    run = ingest(landing(("share_pledge", body, {})), "share_pledge", str(tmp_path), 1)
    assert spark.read.parquet(run.judged_path).count() == run.rejects().count() == 1
    assert sorted(r.reject_reason for r in run.judged().collect()) == ["", "shares_code missing"]
    counts = run.metrics().head()
    assert (counts.units, counts.accepted, counts.rejects, counts.rows_new) == (2, 1, 1, 1)


def test_restricted_release(spark, landing, tmp_path):
    def unit(code, zzb, zb):
        return {
            "gpdm": code, "sname": "AAA", "ltsj": "2018-08-10T00:00:00", "gpcjjgds": 2, "jjsl": 1.0, "kjjsl": 2.0,
            "wltsl": 3.0, "jjsz": 4.0, "zzb": zzb, "zb": zb, "newPrice": 5.0, "xsglx": "k", "jjqesrzdf": 6.0,
            "jjhesrzdf": None,
        }

    units = [unit("1", 0.25, 1), unit("2", 0.00025, 1e-05), unit("3", None, "0.5")]
    body = "var x=" + json.dumps({"pages": 1, "data": units})
    run = ingest(landing(("restricted_release", body, {})), "restricted_release", str(tmp_path), 1)
    got = {r["shares_code"]: (r["equity_ratio"], r["share_ratio"]) for r in rows(run.table())}
    assert got["1"] == (25.0, 1.0) and got["3"] == (None, 50.0)
    assert got["2"] == (pytest.approx(0.025), 1e-05)
    assert rows(run.table())[0]["circulation_date"] == dt.date(2018, 8, 10)


def timeline(page, units, pages=9):
    return json.dumps({"page": page, "maxPage": pages, "count": 20, "list": units})


def test_announcement_and_news(spark, landing, universe, tmp_path):
    units = [
        {"id": 11, "created_at": 1533883920000, "title": "t", "description": 'T <a href="u1">x</a><a href="u2">y</a>'},
        {"id": 12, "created_at": 1533883980000, "title": "s", "description": "plain"},
        {"id": None, "created_at": 1533883980000, "title": "s", "description": "plain"},
    ]
    for name, ident, at in (("announcement", "announce_id", "announce_date"), ("news", "news_id", "date")):
        pages = landing(
            (name, timeline(1, units), {"share_code": "600001"}),
            (name, "<html>are you a robot</html>", {"share_code": "000002"}),
            (name, timeline(1, units), {"share_code": "000002", "status": 503}),
        )
        run = ingest(pages, name, str(tmp_path / name), 1, universe=universe)
        got = {r[ident]: r for r in rows(run.table())}
        assert set(got) == {11, 12}
        assert got[11]["shares_name"] == "AAA" and got[11][at] == dt.datetime(2018, 8, 10, 14, 52)
        assert got[11]["announce_url" if name == "announcement" else "news_url"] == "u2"
        assert got[12]["announce_url" if name == "announcement" else "news_url"] == ""
        assert [r["page_state"] for r in rows(run.refetch())] == [REFETCH] * 2
        assert [r["reject_reason"] for r in rows(run.rejects())] == [f"{ident} missing"]
    items = rows(run.items())
    assert {i["news_text"] for i in items} == {"T ", "plain"}


def test_empty_page_keeps_its_counters(spark, landing):
    spec = feed("share_pledge")
    pages = landing(("share_pledge", "var x={pages:1,data:[]}", {}))
    assert parse_feed(pages, spec).count() == 0
    (page,) = rows(parse_envelope(pages, spec))
    assert page["total_pages"] == 1 and page["page_state"] == OK
    good, bad = split_corrupt(parse_envelope(pages, spec))
    assert (good.count(), bad.count()) == (1, 0)


def test_body_without_wrapper_or_bytes_is_asked_for_again(spark, landing, tmp_path):
    pages = landing(("share_pledge", "{pages:1,data:[]}", {}), ("share_pledge", b"var x=\xff\xfe", {}))
    run = ingest(pages, "share_pledge", str(tmp_path), 1)
    assert [r["page_state"] for r in rows(run.refetch())] == [REFETCH] * 2
    assert run.table().count() == 0


def test_first_name_stays_and_newest_price_wins(spark, landing, tmp_path):
    def page(name, price):
        unit = GRID_UNIT.replace("A(B)", name).replace(",10.5,", f",{price},")
        return landing(("basic_index", 'jQuery({data: ["%s"], recordsFiltered: 1})' % unit, {}))

    ingest(page("old", 1.0), "basic_index", str(tmp_path), 1)
    ingest(page("new", 2.0), "basic_index", str(tmp_path), 2)
    run = ingest(page("old", 1.0), "basic_index", str(tmp_path), 1)  # an old batch delivered again
    (row,) = rows(run.table())
    assert (row["shares_name"], row["latest_price"]) == ("old", 2.0)
    (share,) = rows(share_universe(run.table()))
    assert share == {"shares_code": "600001", "shares_type": "1", "shares_name": "old"}


def test_envelope_is_read_once(spark, landing):
    spec = feed("share_pledge")
    plan = parse_feed(landing(("share_pledge", "var x={pages:1,data:[]}", {})), spec)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1
    assert "Python" not in text


def test_a_gbk_feed_needs_no_python_and_leaves_the_session_as_it_was(spark, landing):
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "false")
        body = 'var x={data:["600001,浦发"],pages:7}'.encode("gbk")
        parsed = parse_feed(landing(("shareholder_change", body, {}), ("shareholder_change", b"\xff\xff", {})), feed("shareholder_change"), keep_empty=True)
        assert "Python" not in parsed._jdf.queryExecution().toString()
        assert [(r["name"], r["page_state"]) for r in parsed.collect()] == [("浦发", "ok"), (None, "refetch")]
        assert [spark.conf.get(name) for name in names] == ["false", "false"]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_pages_of_one_landed_file_are_parsed_by_all_cores(spark, landing, tmp_path):
    unit = ",".join(["1", "{}", "x"] + ["1"] * 21 + ["2018-08-10 15:00:00"])
    pages = [("basic_index", 'jQuery({data: ["%s"], recordsFiltered: 1})' % unit.format(600000 + i), {"page_no": i}) for i in range(40)]
    landing(*pages).coalesce(1).write.parquet(str(tmp_path / "landed"))
    run = ingest_all(spark.read.parquet(str(tmp_path / "landed")), str(tmp_path / "tables"), 1)["basic_index"]
    assert run.parsed().count() == 40
    assert run.parsed().select(F.input_file_name()).distinct().count() == spark.sparkContext.defaultParallelism
