"""Several crawls through one table, exact partition pruning, and what runs count."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sharefold.operators import incremental as inc
from sharefold.operators.merge import with_arrival
from sharefold.plans import forget, ingest, ingest_crawls, replay_rejects, run_metrics
from sharefold.sinks import merge_into_table, pin, read_stored
from sharefold.sinks.tables import stored_in, touched_partitions
from sharefold.sources import stream_landing
from sharefold.streaming import stream_feed

NOW = 500 * inc.DAY_MS


def body(*days):
    units = [{"id": t, "created_at": t * inc.DAY_MS, "description": "d"} for t in days]
    return json.dumps({"page": 1, "maxPage": 9, "count": 20, "list": units})


@pytest.fixture()
def pages(landing):
    """Landing rows with their crawl from (crawl, share, page, days) tuples."""

    def make(*rows):
        parts = [
            landing(("announcement", body(*days), {"share_code": share, "page_no": number})).withColumn("crawl", F.lit(crawl).cast("bigint"))
            for crawl, share, number, days in rows
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    return make


def ids(rows):
    return sorted(r.announce_id for r in rows.collect())


# Two crawls. The second walks down to the first one's newest row; a page of the first crawl lands late, and so does the
# second crawl's newest page.
FIRST = [(1, "600001", 1, (480, 479)), (1, "600001", 2, (478, 477)), (1, "000002", 1, (300,))]
SECOND = [(2, "600001", 2, (482, 481)), (2, "600001", 3, (480, 479)), (2, "600001", 4, (478, 476)), (2, "000002", 1, (490, 300))]
LATE = [(1, "600001", 3, (475, 400)), (1, "600001", 4, (399, 398)), (2, "600001", 1, (484, 483))]
KEPT = [300, 400, 475, 477, 478, 479, 480, 481, 482, 483, 484, 490]


def test_a_stream_over_two_crawls_equals_batch_runs(spark, pages, universe, tmp_path):
    options = {"mode": "newest", "as_of_ms": NOW}
    source, root, state = (str(tmp_path / n) for n in ("landing", "stream", "state"))

    def drain():
        stream = stream_landing(spark, source, "announcement", max_files=1, crawled=True)
        stream_feed(stream, "announcement", root, state, universe=universe, **options).awaitTermination()

    for part in (FIRST, SECOND, LATE):
        pages(*part).coalesce(1).write.mode("append").parquet(source)
        if part is not SECOND:
            drain()
    streamed = read_stored(spark, f"{root}/crawler_company_announcement")
    assert ids(streamed) == KEPT
    batches = str(tmp_path / "batches")
    for batch, part in enumerate((FIRST, SECOND, LATE)):
        runs = ingest_crawls(pages(*part), "announcement", batches, batch, universe, **options)
    assert ids(runs[2].table()) == KEPT
    # Only what is new in a batch is given out.
    assert sorted(int(r.announce_id) for r in runs[1].items().collect()) == [400, 475]
    seen = {(r.run, r.batch): r for r in run_metrics(spark, batches, "announcement").collect()}
    assert (seen[1, 0].pages, seen[1, 0].units, seen[1, 0].accepted, seen[1, 0].rows_new) == (3, 5, 5, 5)
    assert (seen[2, 1].pages, seen[2, 1].accepted, seen[2, 1].rows_new, seen[2, 1].rows_changed) == (4, 6, 3, 3)
    assert (seen[1, 2].pages, seen[1, 2].accepted, seen[2, 2].rows_new) == (2, 2, 2)


def test_crawls_must_be_named(spark, pages, universe, tmp_path):
    stream = stream_landing(spark, str(tmp_path), "announcement")
    with pytest.raises(ValueError, match="crawl"):
        stream_feed(stream, "announcement", str(tmp_path / "r"), str(tmp_path / "s"), universe=universe, mode="newest")
    with pytest.raises(ValueError, match="crawl"):
        ingest_crawls(pages(*FIRST).drop("crawl"), "announcement", str(tmp_path), 1, universe)
    with pytest.raises(ValueError, match="without a crawl"):
        ingest_crawls(pages(*FIRST, (None, "600001", 1, (1,))), "announcement", str(tmp_path), 1, universe)
    assert ingest_crawls(pages(*FIRST).where("false"), "announcement", str(tmp_path), 1, universe) == {}


def test_the_time_of_a_run_is_that_of_its_start(pages, universe, tmp_path):
    """The period's start does not move with later batches."""
    options = {"universe": universe, "mode": "period", "period_days": 10, "run_id": 7}
    ingest(pages((7, "600001", 1, (480, 479))), "announcement", str(tmp_path), 1, as_of_ms=485 * inc.DAY_MS, **options)
    later = pages((7, "600001", 2, (478, 476)), (7, "600001", 3, (475, 470)), (7, "600001", 4, (469,)))
    run = ingest(later, "announcement", str(tmp_path), 2, as_of_ms=488 * inc.DAY_MS, **options)
    assert ids(run.table()) == [470, 475, 476, 478, 479, 480]


def test_a_batch_without_good_rows_is_counted(spark, pages, universe, tmp_path):
    torn = pages((1, "600001", 1, (480,))).withColumn("body", F.lit(b"{").cast("binary"))
    unknown = pages((1, "999999", 1, (480, 479)))
    for batch, rows in enumerate((torn, unknown, unknown.where("false"))):
        run = ingest(rows, "announcement", str(tmp_path), batch, universe, mode="newest", as_of_ms=NOW)
        assert run.table().count() == 0
    assert run.metrics().count() == 1
    seen = {r.batch: r for r in run_metrics(spark, str(tmp_path), "announcement").collect()}
    assert (seen[0].pages, seen[0].refetches, seen[0].units) == (1, 1, 0)
    assert (seen[1].units, seen[1].accepted, seen[1].rejects, seen[1].rows_new) == (2, 0, 2, 0)
    assert seen[2].pages == 0


def scanned_partitions(df):
    """How many partition folders the scans of a finished plan have opened."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        metrics = node.metrics()
        if metrics.contains("numPartitions") and "Scan" in node.nodeName():
            found.append(metrics.apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    months = [dt.date(2018, m, 1) for m in range(1, 13)] + [None]

    def rows(batch, *wanted):
        full = [(f"c{k}", m, batch, k) for k in range(3) for m in wanted]
        made = with_arrival(spark.createDataFrame(full, "code string, month date, price int, at int"), [F.lit(batch), F.col("at")])
        return pin(made.drop("at"), str(tmp_path / f"in{batch}"))

    def merge(batch, *wanted):
        merge_into_table(rows(batch, *wanted), path, ("code", "month"), (), "month")
        return {(r.code, r.month): r.price for r in read_stored(spark, path).collect()}

    assert len(merge(1, *months)) == 39
    two = rows(2, months[0], months[11])
    stored = spark.read.schema(two.schema).parquet(f"{path}/rows")
    near = stored_in(stored, touched_partitions(two, "month", path), "month")
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    assert 2 in scanned_partitions(near) and near.count() == 6
    with_null = stored_in(stored, touched_partitions(rows(3, months[4], None), "month", path), "month")
    assert sorted(n for n in scanned_partitions(with_null) if n) == [1, 1] and with_null.count() == 6
    after = merge(4, months[0], None)
    assert len(after) == 39 and after["c1", None] == after["c2", months[0]] == 4 and after["c1", months[5]] == 1


def test_rejects_are_replayed_once_their_share_is_known(spark, pages, universe, tmp_path):
    first = ingest(pages((1, "999999", 1, (480, 479)), (1, "888888", 1, (300,))), "announcement", str(tmp_path), 1, universe)
    ingest(pages((2, "600001", 1, (480,))).withColumn("body", F.lit(body(480).replace('"d"', '"newer"').encode())), "announcement", str(tmp_path), 2, universe)
    wider = spark.createDataFrame([("999999", "1", "New")], "shares_code string, shares_type string, shares_name string")
    assert replay_rejects(first) == {"replayed": 0, "left": 3}
    assert replay_rejects(first, universe=wider) == {"replayed": 2, "left": 1}
    assert replay_rejects(first, universe=wider) == {"replayed": 0, "left": 1}
    rows = {r.announce_id: r for r in first.table().collect()}
    # What came later stays the newest, and the first name is that of the row that came first.
    assert sorted(rows) == [479, 480] and rows[479].shares_name == "New" and rows[480].announce_title == "newer"
    assert [r.shares_code for r in first.open_rejects().collect()] == ["888888"] and first.rejects().count() == 3


def test_past_batches_can_be_forgotten(spark, pages, universe, tmp_path):
    root, options = str(tmp_path), {"mode": "newest", "as_of_ms": NOW}
    for batch, part in enumerate((FIRST, SECOND)):
        runs = ingest_crawls(pages(*part, (batch + 1, "999999", 1, (9,))), "announcement", root, batch, universe, **options)
    assert forget(spark, root, "announcement", before_batch=0) == 0
    # Parsed rows, shares and last pages of batch 0; then the crawl's marks, start and ends.
    assert forget(spark, root, "announcement", before_batch=1) == 3
    assert forget(spark, root, "announcement", before_batch=1, before_crawl=2, with_rejects=True) == 4
    assert forget(spark, root, "announcement", before_batch=1, before_crawl=2, with_rejects=True) == 0
    # What is left serves the open crawl: its late page is still cut by its own marks.
    late = ingest_crawls(pages(*[p for p in LATE if p[0] == 2]), "announcement", root, 2, universe, **options)
    assert ids(late[2].table()) == [i for i in KEPT if i not in (400, 475)]
    assert runs[2].rejects().count() == 1 and run_metrics(spark, root, "announcement").count() == 3
