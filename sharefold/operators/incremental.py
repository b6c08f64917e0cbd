"""Page bounds and the full, period and newest-only cuts of the timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.operators.lookup import look_up

# Fixed value: the period of the period cut, and the default cut of a share without stored rows.
PERIOD_DAYS = 90
DAY_MS = 86_400_000
ALL, PERIOD, NEWEST = "ALL", "PERIOD", "NEWEST"


def cut_mode(mode: str | None) -> str:
    known = (mode or "").upper()
    if known not in (ALL, PERIOD, NEWEST):
        raise ValueError(f"mode must be all, period or newest, not {mode!r}")
    return known


def period_start(as_of_ms: Column, days: int = PERIOD_DAYS) -> Column:
    return as_of_ms - F.lit(days * DAY_MS)


def page_bounds(units: DataFrame, share: str, page: str, at: str) -> DataFrame:
    """Oldest and newest time of each page; 0 and 0 for a page without units."""
    return units.groupBy(share, page).agg(
        F.coalesce(F.min(at), F.lit(0)).alias("min_created"),
        F.coalesce(F.max(at), F.lit(0)).alias("max_created"),
    )


def cut_rows(rows: DataFrame, at: str, after: Column) -> DataFrame:
    """Row-exact cut: rows newer than ``after``."""
    return rows.where(F.col(at) > after)


def last_pages(bounds: DataFrame, share: str, page: str, stop: Column) -> DataFrame:
    """Per share the first page on which ``stop`` holds: the last one a reader walking the pages would take.

    ``stop`` is a condition on columns of ``bounds``; ``last_page`` is NULL for a share it never holds on.
    """
    return bounds.groupBy(share).agg(F.min(F.when(stop, F.col(page))).alias("last_page"))


def keep_pages(rows: DataFrame, last: DataFrame, share: str, page: str, salted: bool = False) -> DataFrame:
    """Rows of each share's pages up to and including its last one; ``salted`` when ``last`` is not a written table."""
    joined = look_up(rows, last, share, salt=page if salted else None)
    return joined.where(F.col("last_page").isNull() | (F.col(page) <= F.col("last_page"))).drop("last_page")


def cut_pages(rows: DataFrame, bounds: DataFrame, share: str, page: str, stop: Column) -> DataFrame:
    """Page-exact cut: rows of every page up to and including the first one on which ``stop`` holds.

    A window per share would put a busy share in one task. Two hash aggregates give each share's last page, and
    that small result is joined back.
    """
    return keep_pages(rows, last_pages(bounds, share, page, stop), share, page, salted=True)


def stop_rule(mode: str, as_of_ms: Column, days: int = PERIOD_DAYS, cutoff: Column | None = None) -> Column:
    """Does the walk end on this page? Newest-only needs the share's ``cutoff``; it ends on the first page when the
    run is not later than the mark."""
    mode = cut_mode(mode)
    if mode == ALL:
        return F.lit(False)
    if mode == PERIOD:
        return F.col("min_created") <= period_start(as_of_ms, days)
    if cutoff is None:
        raise ValueError("newest mode needs the cutoff column")
    return (as_of_ms <= cutoff) | (F.col("min_created") <= cutoff)
