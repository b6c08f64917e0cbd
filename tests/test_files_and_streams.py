import datetime as dt
import decimal
import glob
import json
from pathlib import Path

from pyspark.sql import functions as F

from sharefold.operators.store import retain, route, split_valid, union_pages
from sharefold.plans import ingest
from sharefold.session import scratch_path, shared_folder
from sharefold.sinks import read_stored, write_jsonl, write_routed
from sharefold.sources import LANDING_SCHEMA, read_landing, read_landing_files, read_table, stream_landing
from sharefold.streaming import drop_repeats, stream_feed, stream_upsert

INFLUX = 'var aff_data={data:[["2018-08-%02d,%s,2,3,4,5,6,7,8,9,10"]]}'


def test_jsonl(spark, tmp_path):
    df = spark.createDataFrame(
        [("中文", decimal.Decimal("1.50"), None, [decimal.Decimal("2.25")])],
        "name string, price decimal(9,2), note string, more array<decimal(9,2)>",
    )
    write_jsonl(df, str(tmp_path / "out"))
    write_jsonl(df, str(tmp_path / "out"))
    text = "".join(Path(p).read_text("utf-8") for p in glob.glob(str(tmp_path / "out" / "part-*")))
    assert "中文" in text
    assert [json.loads(line) for line in text.splitlines()] == [{"name": "中文", "price": 1.5, "note": None, "more": [2.25]}]


def test_item_dump_of_a_run(spark, landing, universe, tmp_path):
    run = ingest(landing(("main_influx", INFLUX % (10, 1.5), {"share_code": "600001"})), "main_influx", str(tmp_path / "s"), 1, universe=universe)
    write_jsonl(run.items(), str(tmp_path / "dump"))
    (row,) = spark.read.json(str(tmp_path / "dump")).collect()
    assert row.symbol == "600001" and row.name == "AAA" and row.last_update_time == "2018-08-10"


def test_routes_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", None)], "feed string, v int")
    assert {n: d.count() for n, d in route(df, ["a", "b"]).items()} == {"a": 2, "b": 1}
    write_routed(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r" / "feed=b")).collect()[0].v == 2
    good, bad = split_valid(df, {"v missing": F.col("v").isNotNull(), "v too high": F.col("v") < 2})
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["v missing; v too high", "v too high"]
    assert union_pages(df, df.select("v"), df.select("feed")).count() == 9


def test_retain(spark):
    df = spark.createDataFrame([(dt.date(2018, 8, d),) for d in (1, 5, 10)], "day date")
    kept = retain(df, "day", 5, F.lit("2018-08-10").cast("date"))
    assert [r.day.day for r in kept.collect()] == [5, 10]


def test_landing_table_and_files(spark, landing, tmp_path):
    path = str(tmp_path / "landing")
    rows = landing(("a", "x", {}), ("b", "y", {}))
    rows.write.parquet(path)
    assert read_landing(spark, path).schema == LANDING_SCHEMA
    only = read_landing(spark, path, "a")
    assert [r.feed for r in only.collect()] == ["a"]
    assert "PushedFilters: [IsNotNull(feed), EqualTo(feed,a)]" in only._jdf.queryExecution().executedPlan().toString()
    assert read_table(spark, path).count() == 2
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "600001_3.html").write_bytes(b"<html/>")
    (folder / "other.txt").write_bytes(b"no")
    (page,) = read_landing_files(spark, str(folder), "financial_notice", "*.html").collect()
    assert (page.share_code, page.page_no, bytes(page.body), page.status) == ("600001", 3, b"<html/>", 200)


def test_files_to_table(spark, universe, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "600001_1.js").write_text(INFLUX % (10, 1.5))
    pages = read_landing_files(spark, str(folder), "main_influx")
    run = ingest(pages, "main_influx", str(tmp_path / "s"), 1, universe=universe)
    assert [r.main_influx_price for r in run.table().collect()] == [1.5]


def test_scratch_lies_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert scratch_path(spark, "x").startswith(f"{named}/") and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_feed_stream_equals_batches(spark, landing, universe, tmp_path):
    """Files landed one after the other; the newest value wins, the stream can be taken up again."""
    path, root = str(tmp_path / "landing"), str(tmp_path / "stream")

    def land(hour, *pages):
        at = dt.datetime(2018, 8, 10, hour, tzinfo=dt.timezone.utc)
        bodies = [("main_influx", INFLUX % p, {"share_code": "600001", "fetched_at": at}) for p in pages]
        landing(*bodies).coalesce(1).write.mode("append").parquet(path)

    def drain():
        stream = stream_landing(spark, path, "main_influx", max_files=1)
        stream_feed(stream, "main_influx", root, f"{root}-state", universe=universe).awaitTermination()
        rows = read_stored(spark, f"{root}/crawler_main_influx").collect()
        return {str(r.date): r.main_influx_price for r in rows}

    land(1, (10, 1.0), (9, 1.0))
    assert drain() == {"2018-08-10": 1.0, "2018-08-09": 1.0}
    land(2, (10, 2.0))
    assert drain() == {"2018-08-10": 2.0, "2018-08-09": 1.0}
    whole = ingest(read_landing(spark, path), "main_influx", str(tmp_path / "batch"), 1, universe=universe)
    assert {str(r.date): r.main_influx_price for r in whole.table().collect()} == drain()


def test_stream_upsert_with_an_offset(spark, tmp_path):
    schema = "code string, day date, name string, price double, at int"
    source, path = str(tmp_path / "in"), str(tmp_path / "t")

    def drain(checkpoint, first_batch):
        stream = spark.readStream.schema(schema).parquet(source)
        stream_upsert(
            stream, path, str(tmp_path / checkpoint), ("code", "day"), ("name",), "day", ["at"], first_batch=first_batch
        ).awaitTermination()

    def land(name, price):
        row = spark.createDataFrame([("c", name, price, 1)], "code string, name string, price double, at int")
        day = F.lit("2018-08-10").cast("date")
        row.select("code", day.alias("day"), "name", "price", "at").write.mode("overwrite").parquet(source)

    land("first", 1.0)
    drain("one", 0)
    land("second", 2.0)
    drain("two", 10)
    (row,) = read_stored(spark, path).collect()
    assert (row["name"], row.price) == ("first", 2.0)


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    schema = "id long, at timestamp_ntz"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        once = drop_repeats(spark.readStream.schema(schema).parquet(source), ["id"], "at")
        query = once.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        query.trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r.id for r in spark.read.schema(schema).parquet(out).collect())

    day = dt.datetime(2024, 6, 1)
    assert land((1, day), (1, day), (2, day)) == [1, 2]
    assert land((1, day + dt.timedelta(days=1)), (3, day)) == [1, 2, 3]
    # Later than the watermark allows: 90 days behind the newest row.
    assert land((4, day + dt.timedelta(days=200))) == [1, 2, 3, 4]
    assert land((5, day), (6, day + dt.timedelta(days=150))) == [1, 2, 3, 4, 6]
