"""Item rows to stored rows, routing by feed and the valid/rejected split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold import feeds as fd
from sharefold.feeds import FeedSpec
from sharefold.functions import code_label, date_head
from sharefold.functions.clock import MINUTE_PATTERN

# Timeline ids grow with time, so a run of neighbouring ids is also a stretch of time: a small batch touches
# few partitions.
ID_RANGE_WIDTH = 1_000_000


def _stored(how: str, item: Column) -> Column:
    if how == fd.DATE_AT_SPACE:
        return date_head(F.trim(item), " ")
    if how == fd.DATE_AT_T:
        return date_head(F.trim(item), "T")
    if how == fd.LABEL:
        return code_label(item)
    if how == fd.LOCAL_MINUTE:
        return F.try_to_timestamp(item, F.lit(MINUTE_PATTERN)).cast("timestamp_ntz")
    return item


def stored_projection(items: DataFrame, spec: FeedSpec, keep: Iterable[str] = ()) -> DataFrame:
    """A feed's item rows under the names and types of its stored table, with the table's partition column; fields
    that are not stored go."""
    columns = [_stored(s.how, F.col(s.item)).alias(s.name) for s in spec.stored]
    return with_partition(items.select(*columns, *keep), spec)


def with_partition(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Stored rows with their table's partition column, made anew from the key."""
    if spec.timeline:
        width = F.lit(ID_RANGE_WIDTH)
        return rows.withColumn("id_range", F.floor(F.col(spec.key[0]) / width).cast("bigint"))
    return rows if spec.by_day else rows.withColumn("month", F.trunc(F.col(spec.key[-1]), "month"))


def key_rules(spec: FeedSpec) -> dict[str, Column]:
    """A stored row needs every part of its key; a timeline row also needs its share."""
    needed = list(spec.key) + (["shares_code"] if spec.timeline else [])
    return {f"{name} missing": F.col(name).isNotNull() for name in needed}


def with_reasons(df: DataFrame, rules: Mapping[str, Column], column: str = "reject_reason") -> DataFrame:
    """Names of the rules a row breaks, '' when it breaks none. A rule that is NULL counts as broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn(column, F.concat_ws("; ", *broken))


def split_valid(
    df: DataFrame, rules: Mapping[str, Column], column: str = "reject_reason"
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the reason. Both read ``df``: pass a written table."""
    judged = with_reasons(df, rules, column)
    return judged.where(F.col(column) == "").drop(column), judged.where(F.col(column) != "")


def route(df: DataFrame, feeds: Iterable[str], column: str = "feed") -> dict[str, DataFrame]:
    """One DataFrame per feed."""
    return {name: df.where(F.col(column) == name) for name in feeds}


def union_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Outputs of several pages or sources in one DataFrame, columns matched by name."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def retain(df: DataFrame, date_column: str, days: int, as_of: Column) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``. An extension: the feeds only name it as a plan."""
    return df.where(F.col(date_column) >= F.date_sub(as_of, days))
