"""A filter of fixed size over 64-bit hashes, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class HashFilter:
    """A bit per hash of ``column`` in ``rows``, as a scalar of 2**bits bits: what it sends to executors does not grow
    with the rows. ``likely`` is true for every hash in it and for few others; a fuller filter only lets more through."""

    def __init__(self, rows: DataFrame, column: str, bits: int = 23):
        self.bits = bits
        slot = self._slot(F.col(column))
        word = F.expr(f"bit_or(shiftleft(1L, cast(`{column}` & 63 as int)))").alias("w")
        words = rows.groupBy(F.shiftright(slot, 6).alias("word")).agg(word)
        every = rows.sparkSession.range(1 << (bits - 6)).join(words, F.col("id") == F.col("word"), "left")
        ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("w", F.lit(0)).alias("w"))))
        self.words = every.agg(F.transform(ordered, lambda x: x["w"]).alias("words")).scalar()

    def _slot(self, value: Column) -> Column:
        return value.bitwiseAND(F.lit((1 << self.bits) - 1))

    def likely(self, value: Column) -> Column:
        word = F.get(self.words, F.shiftright(self._slot(value), 6).cast("int"))
        return F.getbit(word, value.bitwiseAND(F.lit(63)).cast("int")) == 1
