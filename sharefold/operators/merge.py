"""Insert-or-update by key in set form.

On a key that is already stored, the first name stays and every other column takes the newest value. "First" and
"newest" go by arrival: batch, fetch time, page, place in the page. Stored rows carry the arrival of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST, LAST = "_first_seq", "_last_seq"


def arrival(order: Sequence[str | Column]) -> Column:
    return F.struct(*order)


def with_arrival(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows as they come in: their first and newest arrival are the same."""
    seq = arrival(order)
    return rows.withColumns({FIRST: seq, LAST: seq})


def _newest(columns: Sequence[str], key: Sequence[str], sticky: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in {*key, *sticky, FIRST, LAST}]


def _flat(columns: Sequence[str], key: Sequence[str], sticky: Sequence[str]) -> list[Column]:
    """Columns in their order again, from the key and the structs ``_old`` and ``_new``."""
    side = dict.fromkeys(sticky, "_old") | dict.fromkeys(_newest(columns, key, sticky), "_new")
    plain = [F.col(c) if c in key else F.col(f"{side[c]}.`{c}`").alias(c) for c in columns if c not in (FIRST, LAST)]
    return [*plain, F.col(f"_old.{FIRST}").alias(FIRST), F.col(f"_new.{LAST}").alias(LAST)]


def fold_by_key(rows: DataFrame, key: Sequence[str], sticky: Sequence[str]) -> DataFrame:
    """One row per key from rows that carry arrivals.

    Two aggregates do it, each a comparison of structs led by the arrival, so copies of a key collapse before
    the shuffle whatever its share of the rows, and a tie is settled by the values and not by chance.
    """
    folded = rows.groupBy(*key).agg(
        F.min(F.struct(FIRST, *sticky)).alias("_old"),
        F.max(F.struct(LAST, *_newest(rows.columns, key, sticky))).alias("_new"),
    )
    return folded.select(*_flat(rows.columns, key, sticky))


def latest_by_key(rows: DataFrame, key: Sequence[str], sticky: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State of an empty table after all rows arrived in ``order``; the arrivals are dropped."""
    return fold_by_key(with_arrival(rows, order), key, sticky).drop(FIRST, LAST)


def upsert(stored: DataFrame | None, incoming: DataFrame, key: Sequence[str], sticky: Sequence[str]) -> DataFrame:
    """Stored rows after ``incoming`` arrived. Both carry arrivals; ``stored`` has one row per key, or is None.

    Only the incoming rows need folding. Then both sides have one row per key, so a full outer join cannot be
    skewed, and the large stored side is shuffled and sorted once.
    """
    arrived = fold_by_key(incoming, key, sticky)
    if stored is None:
        return arrived

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(
            *[F.col(c).alias(f"{mark}_{c}") for c in key],
            F.struct(FIRST, *sticky).alias(f"{mark}_old"),
            F.struct(LAST, *_newest(arrived.columns, key, sticky)).alias(f"{mark}_new"),
        )

    same = [F.col(f"_stored_{c}").eqNullSafe(F.col(f"_arrived_{c}")) for c in key]
    both = side(stored, "_stored").join(side(arrived, "_arrived"), same, "full_outer")
    # least and greatest pass over the side that is missing.
    merged = both.select(
        *[F.coalesce(f"_stored_{c}", f"_arrived_{c}").alias(c) for c in key],
        F.least("_stored_old", "_arrived_old").alias("_old"),
        F.greatest("_stored_new", "_arrived_new").alias("_new"),
    )
    return merged.select(*_flat(arrived.columns, key, sticky))
