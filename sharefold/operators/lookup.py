"""Joins with a look-up of one row per share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def look_up(
    rows: DataFrame, small: DataFrame, on: str, how: str = "left", salt: str | None = None, salts: int = 64
) -> DataFrame:
    """``rows`` with the columns of ``small``, which has one row per ``on``.

    Without ``salt`` the choice is Spark's: it broadcasts ``small`` when its size is under the session's threshold,
    and otherwise shuffles both and splits a share with too many rows at run time. It cannot split when ``small``
    is an aggregate on ``on`` that feeds the join directly. For those name a ``salt`` column of ``rows`` with many
    values per share: each share is then cut into ``salts`` pieces, and ``small`` is copied to each of them.
    """
    if salt is None:
        return rows.join(small, on, how)
    pieces = F.sequence(F.lit(0), F.lit(salts - 1))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    return salted.join(small.withColumn("_salt", F.explode(pieces)), [on, "_salt"], how).drop("_salt")
