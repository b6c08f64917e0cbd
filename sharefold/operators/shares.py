"""Share universe, high-water marks and what rows take from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.operators.lookup import look_up


def share_universe(
    index: DataFrame,
    code: str = "shares_code",
    kind: str = "shares_type",
    name: str | None = "shares_name",
    at: str = "date",
    ordered: bool = True,
) -> DataFrame:
    """One row per code with the type and name of its latest date, codes without any type left out.

    The rows first shrink to one per distinct (code, type, name) with a plain maximum, which Spark hashes and
    combines before the shuffle; only that remainder is compared by struct.
    """
    labels = [kind] + ([name] if name else [])
    seen = index.where(F.col(kind).isNotNull()).groupBy(code, *labels).agg(F.max(at).alias("_at"))
    picked = seen.groupBy(code).agg(F.max(F.struct("_at", *labels)).alias("_top"))
    out = picked.select(code, *[F.col(f"_top.{c}").alias(c) for c in labels])
    return out.orderBy(code) if ordered else out


def require_shares(universe: DataFrame) -> DataFrame:
    """The universe itself; an empty one is an error, for nothing could be asked for."""
    if universe.isEmpty():
        raise ValueError("the share universe is empty")
    return universe


def high_water(table: DataFrame, code: str, ident: str, at: str) -> DataFrame:
    """Highest id and latest time per code. The cut uses the time; the id is for reports."""
    return table.groupBy(code).agg(F.max(ident).alias("max_id"), F.max(at).alias("max_at"))


def enrich_share(
    rows: DataFrame, universe: DataFrame, on: str = "share_code", how: str = "inner", salt: str | None = None
) -> DataFrame:
    """Rows with the columns of their share; rows of unknown shares go, or stay unfilled with ``how="left"``."""
    return look_up(rows, universe, on, how, salt)


def with_cutoff(
    rows: DataFrame,
    marks: DataFrame,
    on: str,
    mark: str,
    default: Column,
    name: str = "cutoff",
    salt: str | None = None,
) -> DataFrame:
    """Rows with their share's mark as ``name``; ``default`` where the share has none."""
    joined = look_up(rows, marks.select(on, F.col(mark).alias("_mark")), on, salt=salt)
    return joined.withColumn(name, F.coalesce("_mark", default)).drop("_mark")
