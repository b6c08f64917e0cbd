"""Request tables, pages still to get, and what a fetch log says about responses and endpoints."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sharefold.feeds import FeedSpec
from sharefold.functions import exchange_symbol, query_string, share_id, url_param

# Endpoint limits and the kinds of failure that count against an endpoint.
FEW_USES = 20
MANY_USES = 200
CONNECTION_ERRORS = (
    "TimeoutError",
    "ConnectionRefusedError",
    "ResponseNeverReceived",
    "ConnectError",
    "TunnelError",
    "ValueError",
)

# Numbers one row may expand to at once; longer runs are first cut into blocks that can move between tasks.
BLOCK = 10_000


def explode_numbers(df: DataFrame, first: Column, last: Column, name: str, spread: bool = True) -> DataFrame:
    """One row per whole number from ``first`` to ``last``; none when ``last`` is lower.

    A long run never becomes one array: rows expand to blocks, the blocks are spread over the tasks, and each
    block expands where it lands.
    """
    kept = df.columns
    span = F.greatest(last - first + F.lit(1), F.lit(0)).cast("bigint")
    counted = df.select(*kept, first.cast("bigint").alias("_first"), span.alias("_span")).where(F.col("_span") > 0)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_span") - 1) / F.lit(BLOCK)).cast("bigint"))
    cut = counted.select(*kept, "_first", "_span", F.explode(blocks).alias("_block"))
    if spread:
        cut = cut.repartition(F.xxhash64(F.col("_block"), *[F.col(c) for c in kept]))
    start = F.col("_first") + F.col("_block") * F.lit(BLOCK)
    stop = F.col("_first") + F.least(F.col("_span"), (F.col("_block") + 1) * F.lit(BLOCK)) - F.lit(1)
    return cut.select(*kept, F.explode(F.sequence(start, stop)).alias(name))


def pages_of(total_rows: Column, page_size: Column | int) -> Column:
    """Pages that hold ``total_rows`` rows."""
    size = page_size if isinstance(page_size, Column) else F.lit(page_size)
    return F.ceil(total_rows / size).cast("bigint")


def page_plan(counters: DataFrame, pages: str = "total_pages", url: str | None = None, param: str = "page") -> DataFrame:
    """Pages 2 to the last of every first page; with ``url``, that column gets the page number."""
    plan = explode_numbers(counters, F.lit(2), F.col(pages), "page_no")
    return plan if url is None else plan.withColumn(url, url_param(url, param, F.col("page_no")))


def _fill(template: str, values: dict[str, object]) -> Column:
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            value = values.get(name, "")
            parts.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts) if parts else F.lit("")


def request_url(spec: FeedSpec, base: Column | str, page: Column | int = 1, **values: object) -> Column:
    """Address of one page of a feed. ``values`` fill the feed's parameters: symbol, share_id, token, stamp, …"""
    if spec.unit == "html":
        return F.concat(base if isinstance(base, Column) else F.lit(base), _fill("{code}.html", values))
    filled = {"page": page, "size": spec.page_size, **values}
    return query_string(base, {name: _fill(text, filled) for name, text in spec.params})


def fetch_plan(
    shares: DataFrame,
    spec: FeedSpec,
    base: str,
    code: str = "shares_code",
    kind: str = "shares_type",
    pages: Column | int = 1,
    **values: object,
) -> DataFrame:
    """Requests of a per-share feed: every page of every share.

    Shares whose type has no exchange prefix cannot be asked for on a timeline and come back with a NULL address;
    ``split_valid`` sets them aside.
    """
    plan = shares.select(F.col(code).cast("string").alias("share_code"), F.col(kind).alias("_kind"), _pages(pages))
    plan = explode_numbers(plan, F.lit(1), F.col("_pages"), "page_no", spread=not isinstance(pages, int))
    url = request_url(
        spec,
        base,
        F.col("page_no"),
        code=F.col("share_code"),
        symbol=exchange_symbol("share_code", "_kind"),
        share_id=share_id("share_code", "_kind"),
        **values,
    )
    return plan.select(
        F.lit(spec.name).alias("feed"),
        "share_code",
        "page_no",
        F.lit(spec.page_size).alias("page_size"),
        F.when(F.lit(not spec.timeline) | exchange_symbol("share_code", "_kind").isNotNull(), url).alias("url"),
    )


def _pages(pages: Column | int) -> Column:
    return (pages if isinstance(pages, Column) else F.lit(pages)).cast("bigint").alias("_pages")


def first_request(spark: SparkSession, spec: FeedSpec, base: str, **values: object) -> DataFrame:
    """Request for the first page of a feed that is not asked for share by share."""
    return spark.range(1).select(
        F.lit(spec.name).alias("feed"),
        F.lit(None).cast("string").alias("share_code"),
        F.lit(1).cast("bigint").alias("page_no"),
        F.lit(spec.page_size).alias("page_size"),
        request_url(spec, base, 1, **values).alias("url"),
    )


def remaining_pages(counters: DataFrame, spec: FeedSpec) -> DataFrame:
    """Requests for the pages that landed pages announce and that have not landed themselves.

    ``counters`` has one row per landed page, as ``FeedRun.counters`` gives it. Only the highest page count of each
    share goes on, with one of its addresses as the pattern.
    """
    total = F.col("total_pages")
    if spec.counters and spec.counters[0][0] == "total_rows":
        total = pages_of(F.col("total_rows"), F.lit(spec.page_size))
    known = counters.withColumn("share_code", F.coalesce("share_code", F.lit("")))
    shares = known.groupBy("feed", "share_code").agg(F.max(total).alias("_total"), F.min("url").alias("url"))
    plan = explode_numbers(shares, F.lit(1), F.col("_total"), "page_no").drop("_total")
    pending = pending_requests(plan, known, ["feed", "share_code", "page_no"])
    return pending.select(
        "feed",
        F.nullif(F.col("share_code"), F.lit("")).alias("share_code"),
        "page_no",
        F.lit(spec.page_size).alias("page_size"),
        url_param("url", spec.page_param, F.col("page_no")).alias("url"),
    )


def pending_requests(plan: DataFrame, landed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Requests with no good response yet. Landed keys are made distinct first, so repeats do not travel."""
    return plan.join(landed.select(*on).distinct(), list(on), "left_anti")


def fetch_class(status: Column | str, error: Column | str, expected: Iterable[int] = ()) -> Column:
    """What to do with a fetch: accept, retry, switch the endpoint (by status or by connection), or leave it to
    the plain retry."""
    status = F.col(status) if isinstance(status, str) else status
    error = F.col(error) if isinstance(error, str) else error
    retry = F.lit(False)
    for code in expected:
        retry = retry | (status == code)
    return (
        F.when(error.isin(*CONNECTION_ERRORS), "switch_connection")
        .when(error.isNotNull(), "plain_retry")
        .when(status == 200, "accept")
        .when(retry, "retry")
        .otherwise("switch")
    )


def classify_fetches(log: DataFrame, expected: Iterable[int] = ()) -> DataFrame:
    """The fetch log with ``fetch_class``."""
    return log.withColumn("fetch_class", fetch_class("status", "error", expected))


def endpoint_scorecard(log: DataFrame, expected: Iterable[int] = (), fixed: Iterable[str] = ()) -> DataFrame:
    """Uses, failures and verdict per endpoint.

    A failing endpoint is dropped when it was used little, kept when it was used much and only its connection
    failed, else suspended. Endpoints in ``fixed`` and those that never fail are kept.
    """
    kind = fetch_class("status", "error", expected)
    scored = log.withColumn("_class", kind).groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("uses"),
        F.count_if(F.col("_class") == "switch").alias("bad_status"),
        F.count_if(F.col("_class") == "switch_connection").alias("bad_connection"),
        F.max(F.when(F.col("_class") == "accept", F.col("ts"))).alias("last_good_at"),
    )
    pinned = F.lit(False)
    for name in fixed:
        pinned = pinned | (F.col("endpoint") == name)
    verdict = (
        F.when(pinned | (F.col("bad_status") + F.col("bad_connection") == 0), "keep")
        .when(F.col("uses") < FEW_USES, "drop")
        .when((F.col("bad_status") == 0) & (F.col("uses") >= MANY_USES), "keep")
        .otherwise("suspend")
    )
    return scored.withColumn("verdict", verdict)


def usable_endpoints(scorecard: DataFrame) -> DataFrame:
    """Number of endpoints and of those still in use."""
    return scorecard.agg(
        F.count(F.lit(1)).alias("endpoints"), F.count_if(F.col("verdict") == "keep").alias("usable")
    )


def progress(pages: DataFrame, total: str, page: str, size: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows announced, rows covered by the pages read so far, and the rest (below 0 on a part-filled last page)."""
    return (
        pages.groupBy(*by)
        .agg(F.max(total).alias("total_rows"), F.max(F.col(page) * F.col(size)).alias("covered_rows"))
        .withColumn("remaining_rows", F.col("total_rows") - F.col("covered_rows"))
    )


def page_query(df: DataFrame, order: Sequence[Column], page: int, size: int) -> DataFrame:
    """One page of an ordered query, as the sources serve it. ``order`` should end in a unique column."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def page_after(
    df: DataFrame, order: Sequence[tuple[str, bool]], size: int, after: Sequence[object] | None = None
) -> DataFrame:
    """The ``size`` rows that follow the row with the values ``after``, the first ones where that is None.

    ``order`` names the columns, without NULLs, and whether each falls; it should end in a unique column. Unlike the
    numbered page, which carries all earlier rows along, a page deep down costs no more than the first.
    """
    if size < 1:
        raise ValueError("size starts at 1")
    if after is not None:
        beyond, same = F.lit(False), F.lit(True)
        for (name, falls), value in zip(order, after, strict=True):
            column = F.col(name)
            beyond = beyond | (same & ((column < F.lit(value)) if falls else (column > F.lit(value))))
            same = same & (column == F.lit(value))
        df = df.where(beyond)
    return df.orderBy(*[F.desc(n) if falls else F.asc(n) for n, falls in order]).limit(size)
