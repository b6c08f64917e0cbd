"""One run of one feed: parse once, set bad pages and rows aside, cut, merge.

The parsed rows are written to the store before anything else reads them. Every later step (pages to ask for
again, rejected rows, the cut, the touched partitions, the merge) starts from that table and reads the columns it
needs, so bodies are decoded once and a lost executor never causes a second parse.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sharefold.feeds import BASIC_INDEX, FEEDS, FeedSpec, feed
from sharefold.functions import as_of_ms as run_time
from sharefold.functions.clock import wall_clock_to_epoch_ms
from sharefold.operators import incremental as inc
from sharefold.operators.merge import FIRST, LAST, with_arrival
from sharefold.operators.parse import BAD_SHAPE, OK, REFETCH, parse_feed
from sharefold.operators.shares import enrich_share, high_water, require_shares, share_universe, with_cutoff
from sharefold.operators.store import key_rules, stored_projection, with_partition, with_reasons
from sharefold.sinks.tables import merge_feed, pin, read_if_there, read_stored
from sharefold.sources.landing import deal_pages

ARRIVAL = ("batch", "run", "fetched_at", "page_no", "unit_pos")

# What tells a reject from all others, whatever a replay mends in it.
REPLAYED = (*ARRIVAL, "row_id")


@dataclass(frozen=True)
class FeedRun:
    """Where a run put things; each is read lazily."""

    spark: SparkSession
    spec: FeedSpec
    root: str
    batch: int
    run: int

    @property
    def table_path(self) -> str:
        return f"{self.root}/{self.spec.table}"

    @property
    def parsed_path(self) -> str:
        return f"{self.root}/_parsed/{self.spec.name}/run={self.run}/batch={self.batch}"

    def lookup_path(self, name: str) -> str:
        """Where this batch keeps a look-up."""
        return f"{self.run_lookup_path(name)}/batch={self.batch}"

    def run_lookup_path(self, name: str) -> str:
        """Where all batches of the run keep theirs."""
        return f"{self.root}/_lookups/{self.spec.name}/{name}/run={self.run}"

    def parsed(self) -> DataFrame:
        return self.spark.read.parquet(self.parsed_path)

    def table(self) -> DataFrame | None:
        """The feed's stored table after this run; None when nothing was stored yet."""
        stored = read_stored(self.spark, self.table_path)
        return None if stored is None else stored.select(*self.spec.columns)

    def taken(self) -> DataFrame:
        """Parsed rows of this batch on the pages that the run took."""
        if not self.spec.timeline:
            return self.parsed()
        last = read_if_there(self.spark, self.lookup_path("last_pages"))
        return self.parsed() if last is None else inc.keep_pages(self.parsed(), last, "share_code", "page_no")

    def units(self, rows: DataFrame) -> DataFrame:
        """The units among parsed rows. A notice without a date is no notice: it goes without being a reject."""
        units = rows.where((F.col("page_state") == OK) & F.col("unit_pos").isNotNull())
        if self.spec.unit == "html":
            units = units.where(F.coalesce(F.col("announcement_date"), F.lit("")) != "")
        return units

    def items(self) -> DataFrame:
        """Items that this batch gives out, for the JSON-lines dump: units of known shares on the pages taken."""
        units = self.units(self.taken())
        if self.spec.per_share:
            units = units.where(F.coalesce("share_known", F.lit(False)))
        return units.select(*[f.name for f in self.spec.fields])

    def refetch(self) -> DataFrame:
        """Pages to ask for again, and those of a changed shape, with their state."""
        pages = self.parsed().where(F.col("page_state") != OK)
        return pages.select("feed", "url", "share_code", "page_no", "fetched_at", "page_state")

    def judge(self, rows: DataFrame) -> DataFrame:
        """Stored form of the units among parsed rows, with their arrival and the rules each breaks."""
        spec = self.spec
        numbers = {"batch": F.lit(self.batch).cast("bigint"), "run": F.lit(self.run).cast("bigint")}
        units = self.units(rows).withColumns(numbers)
        keep = ("url", *ARRIVAL, "share_known") if spec.per_share else ("url", *ARRIVAL)
        rows = stored_projection(units, spec, keep=keep)
        # Pages of several shares can arrive alike, so what a unit says tells it from others of its arrival.
        return with_reasons(rows.withColumn("row_id", F.xxhash64("url", *spec.columns)), self.rules())

    def rules(self) -> dict[str, Column]:
        """What a unit must fulfil to be stored."""
        known = {"share unknown": F.col("share_known")} if self.spec.per_share else {}
        return {**known, **key_rules(self.spec)}

    @property
    def judged_path(self) -> str:
        return f"{self.root}/_judged/{self.spec.name}/run={self.run}/batch={self.batch}"

    def judged(self) -> DataFrame:
        """The batch's units as they were judged; ``reject_reason`` is '' for those that went on to the table. Only a timeline
        writes them all, once they are cut; others judge the parsed rows again."""
        return self.spark.read.parquet(self.judged_path) if self.spec.timeline else self.judge(self.parsed())

    def rejects(self) -> DataFrame:
        """Units that could not be stored, with the reason. They stay on record for ``replay_rejects``."""
        return self.spark.read.parquet(self.judged_path).where(F.col("reject_reason") != "")

    @property
    def replayed_path(self) -> str:
        return f"{self.root}/_replayed/{self.spec.name}/run={self.run}/batch={self.batch}"

    def open_rejects(self) -> DataFrame:
        """The rejects that no replay has stored."""
        rejects, done = self.rejects(), read_if_there(self.spark, self.replayed_path)
        if done is None:
            return rejects
        mine = done.select(*[F.col(c).alias(f"_done_{c}") for c in REPLAYED])
        return rejects.join(mine, [F.col(c).eqNullSafe(F.col(f"_done_{c}")) for c in REPLAYED], "left_anti")

    def metrics(self) -> DataFrame:
        """What this batch read and changed, one row; see ``run_metrics``."""
        return self.spark.read.schema(METRICS_SCHEMA).parquet(_metrics_path(self))

    def counters(self) -> DataFrame:
        """Paging counters of this batch's pages, one row per page, for the page plan."""
        columns = ("feed", "url", "share_code", "page_no", "page_size", "total_rows", "total_pages")
        first_rows = F.coalesce(F.col("unit_pos"), F.lit(0)) == 0
        return self.parsed().where((F.col("page_state") == OK) & first_rows).select(*columns)


# What the steps of a run count while they write; none of it costs a job over the data.
METRICS = ("pages", "refetches", "bad_shapes", "units", "accepted", "rejects", "rows_new", "rows_changed")
METRICS_SCHEMA = StructType([StructField(name, LongType()) for name in METRICS])


def _metrics_path(run: FeedRun) -> str:
    return f"{run.root}/_metrics/{run.spec.name}/run={run.run}/batch={run.batch}"


def run_metrics(spark: SparkSession, root: str, feed_name: str) -> DataFrame:
    """What each run and batch of a feed read and changed: run, batch and METRICS. A batch that ran again counts once.

    ``pages`` are responses, ``refetches`` and ``bad_shapes`` those to ask for again, ``units`` rows on good pages;
    ``accepted`` and ``rejects`` are the units that the run judged, those on pages beyond its cut not among them;
    ``rows_new`` and ``rows_changed`` are stored rows that the batch added, or gave their newest value.
    """
    schema = StructType([StructField("run", LongType()), StructField("batch", LongType()), *METRICS_SCHEMA])
    return spark.read.schema(schema).parquet(f"{root}/_metrics/{feed_name}")


def _total(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0))


def stage_feed(
    landing: DataFrame, spec: FeedSpec, run: FeedRun, universe: DataFrame | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Parses a batch and writes it; returns the written rows and what was counted meanwhile."""
    rows = parse_feed(landing.where(F.col("feed") == spec.name), spec, keep_empty=True)
    if spec.per_share:
        if universe is None:
            raise ValueError(f"feed {spec.name} needs the share universe")
        names = universe.select(
            F.col("shares_code").cast("string").alias("share_code"),
            F.col("shares_name").alias("name"),
        )
        # One row per code, whatever the caller's universe holds.
        names = names.groupBy("share_code").agg(F.min("name").alias("name"), F.lit(True).alias("share_known"))
        names = require_shares(pin(names, run.lookup_path("shares")))
        rows = enrich_share(rows, names, how="left")
    seen, page = Observation(), F.coalesce(F.col("unit_pos"), F.lit(0)) == 0
    watched = rows.observe(
        seen,
        _total(page).alias("pages"),
        _total(page & (F.col("page_state") == REFETCH)).alias("refetches"),
        _total(page & (F.col("page_state") == BAD_SHAPE)).alias("bad_shapes"),
        _total((F.col("page_state") == OK) & F.col("unit_pos").isNotNull()).alias("units"),
    )
    return pin(watched, run.parsed_path, compression="zstd"), seen.get


def _cut(rows: DataFrame, spec: FeedSpec, run: FeedRun, mode: str, as_of: int | None, days: int) -> DataFrame:
    """Page-exact cut of a batch of a timeline, as a reader walking pages newest first would take them.

    A run's walk ends on the first page that reaches the cut, whichever batch brings it. So a batch only needs, of the
    batches before it, the pages that ended the walk of a share: later ones move an end forward and never back, and a page
    that was left out stays out. Each batch notes the ends it finds, and its own rows are all it reads.
    """
    if mode == inc.ALL:
        return rows
    now = _started(run, as_of)
    bounds = inc.page_bounds(rows.where(F.col("page_state") == OK), "share_code", "page_no", "created_ms")
    if mode == inc.PERIOD:
        stop = inc.stop_rule(mode, now, days)
    else:
        bounds = with_cutoff(bounds, _marks(spec, run), "share_code", "mark", inc.period_start(now, days))
        stop = inc.stop_rule(mode, now, days, F.col("cutoff"))
    ends = inc.last_pages(bounds, "share_code", "page_no", stop).where(F.col("last_page").isNotNull())
    pin(ends, run.lookup_path("ends"))
    known = run.spark.read.schema(ends.schema).parquet(run.run_lookup_path("ends"))
    last = pin(known.groupBy("share_code").agg(F.min("last_page").alias("last_page")), run.lookup_path("last_pages"))
    return inc.keep_pages(rows, last, "share_code", "page_no")


def _started(run: FeedRun, as_of: int | None) -> Column:
    """Time of the run: its first batch notes it and all others keep it."""
    path = run.run_lookup_path("started")
    noted = read_if_there(run.spark, path)
    if noted is None:
        noted = pin(run.spark.range(1).select(run_time(as_of).alias("as_of_ms")), path)
    return F.lit(noted.head().as_of_ms)


def _marks(spec: FeedSpec, run: FeedRun) -> DataFrame:
    """Newest stored time per share as the run found it. Its first batch writes the marks and all others read them, so
    what a run has stored itself never ends its walk."""
    path = run.run_lookup_path("marks")
    known = read_if_there(run.spark, path)
    if known is not None:
        return known
    stored = run.table()
    if stored is None:
        return pin(run.spark.createDataFrame([], "share_code string, mark bigint"), path)
    at = next(s.name for s in spec.stored if s.how == "local_minute")
    marks = high_water(stored, "shares_code", spec.key[0], at)
    return pin(
        marks.select(F.col("shares_code").alias("share_code"), wall_clock_to_epoch_ms(F.col("max_at")).alias("mark")), path
    )


def _refuse_older(run: FeedRun) -> None:
    """Notes the batch as the feed's last one; an error where a later one was noted before."""
    path = f"{run.root}/_lookups/{run.spec.name}/last_batch"
    known = read_if_there(run.spark, path)
    last = None if known is None else known.agg(F.max("batch").alias("batch")).head().batch
    if last is not None and run.batch < last:
        raise ValueError(f"batch {run.batch} of {run.spec.name} comes after batch {last}: only_changes needs them in order")
    if last != run.batch:
        run.spark.range(1).select(F.lit(run.batch).cast("bigint").alias("batch")).write.mode("append").parquet(path)


def ingest(
    landing: DataFrame,
    feed_name: str,
    root: str,
    batch: int,
    universe: DataFrame | None = None,
    mode: str = "all",
    as_of_ms: int | None = None,
    period_days: int = inc.PERIOD_DAYS,
    extra_keys: tuple[str, ...] = (),
    run_id: int | None = None,
    only_changes: bool = False,
) -> FeedRun:
    """Brings a feed's table up to date with a batch of landed responses.

    ``batch`` is the arrival number of the batch; running the same batch again changes nothing. ``mode`` (all,
    period, newest) matters for timelines only. A run whose pages land in several batches names them all by one
    ``run_id`` (the first batch's number, say): its time and its marks are those of its start, and its walk over a share ends
    where any of its batches ended it. Without it every batch is a run of its own. Pages of several crawls must not be one
    run, since their page numbers mean different pages: ``ingest_crawls`` takes them apart. An empty page ends a walk.

    ``only_changes`` rewrites only partitions in which a value changes, for feeds whose responses repeat a long
    history. It then matters that batches come in order, so one older than the last is refused with a ValueError.
    """
    spec = feed(feed_name)
    mode = inc.cut_mode(mode)
    run = FeedRun(landing.sparkSession, spec, root, batch, batch if run_id is None else run_id)
    if only_changes:
        _refuse_older(run)
    rows, counted = stage_feed(landing, spec, run, universe)
    if spec.timeline:
        rows = _cut(rows, spec, run, mode, as_of_ms, period_days)
    seen, sound = Observation(), F.col("reject_reason") == ""
    judged = run.judge(rows)
    watched = judged.observe(seen, _total(sound).alias("accepted"), _total(~sound).alias("rejects"))
    if spec.timeline:
        # Cut once, by a join.
        judged = pin(watched, run.judged_path)
    else:
        # Judging reads one parsed row at a time, so the record of rejects is all that is written of it.
        pin(watched.where(~sound), run.judged_path)
    changed = _store(run, judged.where(sound), extra_keys, only_changes)
    counts = {**counted, **seen.get, **changed}
    pin(run.spark.range(1).select(*[F.lit(counts[n]).cast("bigint").alias(n) for n in METRICS]), _metrics_path(run))
    return run


def _store(run: FeedRun, good: DataFrame, extra_keys: tuple[str, ...], only_changes: bool = False) -> dict[str, int]:
    """Merges units that keep all rules, under the arrival they carry, and tells how many rows that changed."""
    spec = run.spec
    partition = [spec.partition] if spec.partition not in spec.columns else []
    incoming = with_arrival(good, ARRIVAL).select(*spec.columns, *partition, FIRST, LAST)
    first, last = ((F.col(f"{seq}.batch") == run.batch) & (F.col(f"{seq}.run") == run.run) for seq in (FIRST, LAST))
    return merge_feed(incoming, run.table_path, spec, extra_keys, only_changes, {"rows_new": _total(first), "rows_changed": _total(last & ~first)})


def replay_rejects(
    run: FeedRun,
    mend: Callable[[DataFrame], DataFrame] | None = None,
    universe: DataFrame | None = None,
    extra_keys: tuple[str, ...] = (),
) -> dict[str, int]:
    """Stores those rejects of a batch that keep the rules by now, and tells how many are ``replayed`` and ``left``.

    ``universe`` makes shares known that were not; ``mend`` takes the rejects and gives them back with values put right, all
    columns of ``rejects`` among them. A row keeps the arrival of the page it came on: it never overwrites what came later,
    and a replay that is repeated, or dies and runs again, has no further effect. The record of what was replayed is
    written after the rows, so a crash between the two only means that they are merged once more.
    """
    spec, rows = run.spec, run.open_rejects()
    if universe is not None and spec.per_share:
        names = universe.select(F.col("shares_code").cast("string").alias("shares_code"), F.col("shares_name").alias("_name"))
        names = names.groupBy("shares_code").agg(F.min("_name").alias("_name"), F.lit(True).alias("_known"))
        rows = enrich_share(rows, pin(names, f"{run.replayed_path}-shares"), "shares_code", how="left")
        known = F.coalesce("share_known", F.lit(False)) | F.coalesce("_known", F.lit(False))
        rows = rows.withColumns({"share_known": known, "shares_name": F.coalesce("shares_name", "_name")}).drop("_name", "_known")
    if mend is not None:
        rows = mend(rows)
    seen, sound = Observation(), F.col("reject_reason") == ""
    judged = with_reasons(with_partition(rows.drop("reject_reason"), spec), run.rules())
    judged = pin(judged.observe(seen, _total(sound).alias("replayed"), _total(~sound).alias("left")), f"{run.replayed_path}-judged")
    counts = seen.get
    if counts["replayed"]:
        _store(run, judged.where(sound), extra_keys)
        judged.where(sound).select(*REPLAYED).write.mode("append").parquet(run.replayed_path)
    return counts


def ingest_crawls(
    landing: DataFrame, feed_name: str, root: str, batch: int, universe: DataFrame | None = None, **options: object
) -> dict[int, FeedRun]:
    """``ingest`` of a batch that brings pages of several crawls, named by the landing's column ``crawl``.

    Crawls are taken one after another by their number. Each is a run of its own: the marks of a crawl are what is stored
    when its first page lands, rows of the crawls before it included, and pages of an older crawl that land late are still
    cut by that crawl's marks. A landing has a handful of crawls at a time; their numbers come to the driver. A page
    without a crawl is an error.
    """
    if "crawl" not in landing.columns:
        raise ValueError("the landing needs the column crawl")
    crawls = sorted((r.crawl for r in landing.where(F.col("feed") == feed_name).select("crawl").distinct().collect()), key=lambda c: (c is not None, c))
    if None in crawls:
        raise ValueError("a page without a crawl number")
    return {
        crawl: ingest(deal_pages(landing.where(F.col("crawl") == crawl)), feed_name, root, batch, universe, run_id=crawl, **options)
        for crawl in crawls
    }


def ingest_all(
    landing: DataFrame,
    root: str,
    batch: int,
    universe: DataFrame | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, FeedRun]:
    """Takes a landing of several feeds to the table of each: one run for every known feed that is in it, by name.

    ``landing`` is read once per feed under a filter on ``feed``, which prunes a table partitioned by it. Basic index
    rows go first. Feeds that need the share universe take ``universe``, or that of the stored basic index.
    ``options`` holds further arguments of ``ingest`` by feed.
    """
    known = landing.where(F.col("feed").isin(*FEEDS)).select("feed").distinct()  # no more rows than there are feeds
    present = {r.feed for r in known.collect()}
    runs: dict[str, FeedRun] = {}
    for name in sorted(present, key=lambda n: (FEEDS[n].per_share, n)):
        if FEEDS[name].per_share and universe is None:
            index = FeedRun(landing.sparkSession, BASIC_INDEX, root, batch, batch).table()
            if index is None:
                raise ValueError(f"feed {name} needs the share universe, and no basic index is stored")
            universe = pin(share_universe(index), f"{root}/_lookups/universe/batch={batch}")
        runs[name] = ingest(deal_pages(landing.where(F.col("feed") == name)), name, root, batch, universe=universe, **(options or {}).get(name, {}))
    return runs
