import pytest
from pyspark.sql import functions as F

from sharefold import functions as fx
from sharefold.functions.clock import MINUTE_PATTERN


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).head().r


@pytest.mark.parametrize(
    ("ms", "text"),
    [(1533883920000, "2018-08-10 14:52:00"), (1533883920999, "2018-08-10 14:52:00"), (0, "1970-01-01 08:00:00")],
)
def test_epoch_to_bj(spark, ms, text):
    assert one(spark, fx.epoch_to_bj("v", "ms"), ms, "bigint") == text
    assert one(spark, fx.epoch_to_bj("v", "MS", MINUTE_PATTERN), ms, "bigint") == text[:16]
    assert one(spark, fx.epoch_to_bj("v", "s"), ms // 1000, "bigint") == text
    assert one(spark, fx.epoch_to_bj("v", "h"), ms, "bigint") == ""


def test_clock_does_not_depend_on_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, fx.epoch_to_bj("v", "ms"), 1533883920000, "bigint") == "2018-08-10 14:52:00"
            assert one(spark, fx.bj_to_epoch("v", "ms", MINUTE_PATTERN), "2018-08-10 14:52") == 1533883920000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bj_to_epoch(spark):
    assert one(spark, fx.bj_to_epoch("v", "s"), "2018-08-10 14:52:00") == 1533883920
    assert one(spark, fx.bj_to_epoch("v", "ms"), "no date") is None
    assert one(spark, fx.bj_to_epoch("v", "d"), "2018-08-10 14:52:00") == 0


def test_round_trip_at_minute_precision(spark):
    df = spark.range(0, 2_000_000_000, 7_654_320).select((F.floor(F.col("id") / 60) * 60000).alias("ms"))
    back = df.select("ms", fx.bj_to_epoch(fx.epoch_to_bj("ms", "ms", MINUTE_PATTERN), "ms", MINUTE_PATTERN).alias("b"))
    # Beijing kept summer time from 1986 to 1991; the doubled hour each autumn has two instants.
    assert back.where((F.col("ms") != F.col("b")) & ~F.from_unixtime(F.col("ms") / 1000, "yyyy").between("1986", "1991")).count() == 0


def test_as_of(spark):
    assert one(spark, fx.as_of_ms(5)) == 5
    assert one(spark, fx.as_of_ms()) % 1000 == 0


@pytest.mark.parametrize(
    ("text", "value"), [("0.25", 25.0), ("-0.5", -50.0), ("1", 1.0), ("1e-05", 1e-05), ("None", None), (None, None)]
)
def test_gated_ratio(spark, text, value):
    assert one(spark, fx.scale_ratio("v", gated=True), text) == value


@pytest.mark.parametrize(
    ("number", "value"),
    [("0.10", 10.0), ("0.00012", 0.012), ("12345678.5", 1234567850.0), ("1e-05", 1e-05), ("3", 3.0), ("0.0", 0.0)],
)
def test_gated_ratio_of_json_numbers(spark, number, value):
    read = F.from_json("v", "a string")
    got = one(spark, fx.scale_ratio(read["a"], gated=True, from_json=True), f'{{"a":{number}}}')
    assert got == pytest.approx(value)


def test_ungated_ratio(spark):
    assert one(spark, fx.scale_ratio("v"), "0.5") == 50.0
    assert one(spark, fx.scale_ratio("v"), None) is None


def test_progress_labels(spark):
    labels = [one(spark, fx.code_label("v"), c) for c in ("001", "002", "003", "004", "005", "006", "009", None)]
    assert labels == ["董事会预案", "股东大会通过", "股东大会否决", "实施中", "停止实施", "完成实施", "未定义", "未定义"]


def test_exchange_symbol(spark):
    got = [one(spark, fx.exchange_symbol(F.lit("600001"), "v"), k) for k in ("1", "2", "3", None)]
    assert got == ["SH600001", "SZ600001", None, None]
    assert one(spark, fx.share_id(F.lit("600001"), "v"), "1") == "6000011"


def test_numbers_and_dates(spark):
    assert one(spark, fx.to_double("v"), "-") is None
    assert one(spark, fx.to_bigint("v"), "12") == 12
    assert one(spark, fx.zero_if_null("v"), None, "bigint") == 0
    assert str(one(spark, fx.date_head("v"), "2018-08-10 14:52:00")) == "2018-08-10"
    assert str(one(spark, fx.date_head("v", "T"), "2018-08-10T00:00:00")) == "2018-08-10"
    assert one(spark, fx.date_head("v"), "-") is None


@pytest.mark.parametrize(
    ("text", "inner"),
    [
        ("jQuery({a: 1})", "{a: 1}"),
        ('cb({name: "A(B)"})', '{name: "A(B)"}'),
        ("cb({a:\n1});\n", "{a:\n1}"),
        ("plain", None),
    ],
)
def test_unwrap_jsonp(spark, text, inner):
    assert one(spark, fx.unwrap_jsonp("v"), text) == inner


@pytest.mark.parametrize(
    ("text", "rest"),
    [("var x={a:1}", "{a:1}"), ('var x={a:"b=1"}', '{a:"b=1"}'), ("var x=={a:1}", "{a:1}"), ("{a:1}", None)],
)
def test_unwrap_assignment(spark, text, rest):
    assert one(spark, fx.unwrap_assignment("v"), text) == rest


@pytest.mark.parametrize(
    ("text", "head", "url"),
    [
        ('T <a href="u1">x</a> m <a href="u2">y</a> z', "T ", "u2"),
        ("plain text", "plain text", ""),
        ('T\n<a href="u1">x</a>', "T\n", "u1"),
        ('a <a href="u1">x\n</a>', 'a <a href="u1">x\n</a>', ""),
        ('one <a href="u1">x</a>\ntwo <a href="u2">y</a>', "one ", "u1"),
        ("T <a title=\"a>b\" href='u?a=1&amp;b=2'>x</a>", "T ", "u?a=1&b=2"),
        ("T <a>x</a>", "T ", None),
        ("", "", ""),
    ],
)
def test_anchor(spark, text, head, url):
    assert one(spark, fx.anchor_head("v"), text) == head
    assert one(spark, fx.anchor_url("v"), text) == url


def test_anchor_with_a_very_long_text(spark):
    text = "x" * 300_000 + '<a href="u" title="' + "y" * 300_000 + '">t</a>' + "z" * 300_000
    assert one(spark, fx.anchor_url("v"), text) == "u"
    assert len(one(spark, fx.anchor_head("v"), text)) == 300_000


def test_decode(spark):
    assert one(spark, fx.decode_body("v"), "中文".encode(), "binary") == "中文"
    assert one(spark, fx.decode_body("v"), b"\xff\xfe\xfa", "binary") is None
    assert one(spark, fx.decode_body("v", "GBK"), "中文".encode("gbk"), "binary") == "中文"
    assert one(spark, fx.decode_body("v", "GBK"), b"\xff\xff", "binary") is None
    assert one(spark, fx.decode_body("v", "GBK"), None, "binary") is None


def test_gbk_in_the_jvm_equals_the_pandas_reader(spark):
    raw = [("股东增持a".encode("gbk"),), (b"\x81",), (b"",), (None,)]
    df = spark.createDataFrame(raw, "v binary")
    arrow = [r.r for r in df.select(fx.decode_body("v", "GBK").alias("r")).collect()]
    for name in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"):
        spark.conf.set(name, "true")
    try:
        plan = df.select(fx.decode_body("v", "GBK", jvm_charsets=True).alias("r"))
        assert [r.r for r in plan.collect()] == arrow == ["股东增持a", None, "", None]
    finally:
        for name in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"):
            spark.conf.unset(name)


def test_urls(spark):
    url = fx.query_string("https://feed.example/x", {"symbol": F.col("v"), "count": 20, "name": "a b"})
    assert one(spark, url, "SH1") == "https://feed.example/x?symbol=SH1&count=20&name=a b"
    encoded = fx.query_string("https://feed.example/x", {"name": "a b&c"}, encode=True)
    assert one(spark, encoded) == "https://feed.example/x?name=a+b%26c"
    assert one(spark, fx.url_param("v", "p", 12), "u?ps=300&p=1&xp=4") == "u?ps=300&p=12&xp=4"
    assert one(spark, fx.url_param("v", "page", 2), "u?q=1") == "u?q=1"
    assert one(spark, fx.url_param("v", "id", F.lit("$1\\")), "u?id=abc") == "u?id=$1\\"
