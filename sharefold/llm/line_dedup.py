"""Line dedup by winnowing over line hashes, with DataFrame functions only.

From every line, the shortest window of whole lines with ``min_words`` words is taken, once forwards and once
backwards. Each window selects its minimum, a fingerprint line: a repeated run holds whole windows, so the copies of a run
select the same lines of it. Fingerprints that stand nowhere else put their windows aside. Windows of the others are
joined by what they hold, and a window with an earlier copy goes. The windows of a run, forwards from its first lines
and backwards from its last, cover it from end to end, which extends a match both ways as far as it goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.common import with_settled
from sharefold.llm.filters import HashFilter
from sharefold.session import scratch_path
from sharefold.sinks import pin

# Repeated runs of lines with at least so many words are removed.
MIN_WORDS = 50


def lines_of(text: Column) -> Column:
    """The lines that have a word, in order: struct<at, a, n> of line number, hash and number of words."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line, i: F.struct(i.alias("at"), F.xxhash64(line).alias("a"), F.regexp_count(line, F.lit(r"\S+")).alias("n")),
    )
    return F.filter(lines, lambda x: x["n"] > 0)


def window_from(lines: str, i: Column, way: int, min_words: int) -> Column:
    """The shortest window with ``min_words`` words from line ``i`` on, forwards (``way`` 1) or backwards (-1), NULL when
    the text ends before: its first and last line (lo, hi), a hash of its lines in reading order of the way, and the hash
    of its fingerprint line. The minimum that it selects is its line of most words, then of highest hash."""
    size = F.size(lines)
    room = F.least(F.lit(min_words), size - i if way == 1 else i + 1)
    start = F.struct(
        F.lit(0).alias("words"), F.lit(way).cast("bigint").alias("hash"),
        F.struct(F.lit(-1).alias("n"), F.lit(0).cast("bigint").alias("a")).alias("best"), i.alias("end"),
    )

    def take(state: Column, k: Column) -> Column:
        x = F.get(lines, i + k * way)
        more = F.struct(
            (state["words"] + x["n"]).alias("words"), F.xxhash64(state["hash"], x["a"]).alias("hash"),
            F.greatest(state["best"], F.struct(x["n"].alias("n"), x["a"].alias("a"))).alias("best"), (i + k * way).alias("end"),
        )
        return F.when(state["words"] < min_words, more).otherwise(state)

    def close(state: Column) -> Column:
        ends = (F.get(lines, F.least(i, state["end"]))["at"], F.get(lines, F.greatest(i, state["end"]))["at"])
        whole = F.struct(ends[0].alias("lo"), ends[1].alias("hi"), state["hash"].alias("hash"), state["best"]["a"].alias("mark"))
        return F.when(state["words"] >= min_words, whole)

    return F.aggregate(F.sequence(F.lit(0), room - 1), start, take, close)


def windows(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """Per document: _doc, _row and its windows, as an array."""
    staged = docs.select(F.col(key).alias("_doc"), F.xxhash64(text).alias("_row"), F.explode(F.array(lines_of(F.col(text)))).alias("lines"))
    every = F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.array(window_from("lines", i, 1, min_words), window_from("lines", i, -1, min_words)))
    found = F.filter(F.flatten(every), lambda w: w.isNotNull())
    return staged.where(F.size("lines") > 0).select("_doc", "_row", found.alias("windows"))


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Line numbers to remove, one row per document that has any: _doc, _row, removed (array<int>, blank lines among them).

    A window goes where the same lines stand at an earlier place (smaller key, then text hash, then line) that it does
    not overlap. The earliest place of each window is an aggregate, combined before the shuffle, so a window that a
    third of all documents share costs a row a task; the join with it is one that Spark splits by itself.
    """
    spark = docs.sparkSession
    found = pin(windows(docs, key, text, min_words), scratch_path(spark, "windows"))
    each = found.select("_doc", "_row", F.explode("windows").alias("w")).select("_doc", "_row", "w.*")
    # Of a fingerprint at two places there are two windows at least. Most lines are nowhere else, and a filter of fixed
    # size keeps nearly all of their windows out of what follows.
    again = HashFilter(each.groupBy("mark", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mark")
    likely = each.where(again.likely(F.col("mark")))
    place = F.struct("_doc", "_row", "lo", "hi")
    first = likely.groupBy("mark", "hash").agg(F.count(F.lit(1)).alias("many"), F.min(place).alias("first")).where(F.col("many") > 1)
    first = pin(first.drop("many"), scratch_path(spark, "first-windows"))
    same_text = F.col("_doc").eqNullSafe(F.col("first._doc")) & (F.col("_row") == F.col("first._row"))
    later = likely.join(first, ["mark", "hash"]).where(~same_text | (F.col("lo") > F.col("first.hi")))
    return (
        later.select("_doc", "_row", F.explode(F.sequence("lo", "hi")).alias("line"))
        .groupBy("_doc", "_row")
        .agg(F.collect_set("line").alias("removed"))
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines removed from the text, and ``_removed``, how many lines went.

    Every line goes that lies in a run of whole lines with ``min_words`` words or more which also stands at an earlier
    place, in the same text or another. Lines without a word are never counted, compared or removed. A null or empty text
    and one with fewer words than ``min_words`` stay as they are. Rows that repeat key and text are one document: all keep the same
    lines, so removing repeated rows is left to whole-document dedup. A null key sorts first. All columns and rows stay;
    a column ``_removed`` or one that starts with ``__dedup`` is refused.
    """
    clash = [c for c in docs.columns if c == "_removed" or c.startswith("__dedup")]
    if clash:
        raise ValueError(f"the documents have columns {clash} already")
    cuts = repeated_lines(docs, key, text, min_words).toDF("__dedup_key", "__dedup_row", "__dedup_cut")
    same = docs[key].eqNullSafe(F.col("__dedup_key")) & (F.xxhash64(docs[text]) == F.col("__dedup_row"))
    joined = docs.join(cuts, same, "left").drop("__dedup_key", "__dedup_row")
    joined = with_settled(joined, "__dedup_lines", F.when(F.col("__dedup_cut").isNotNull(), F.split(text, "\n")))
    blank = F.filter(F.transform("__dedup_lines", lambda line, i: F.when(~line.rlike(r"\S"), i)), lambda i: i.isNotNull())
    joined = with_settled(joined, "__dedup_gone", F.array_except("__dedup_cut", blank))
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("__dedup_lines") - 1), "__dedup_gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get("__dedup_lines", i)), "\n")
    cut = F.col("__dedup_gone").isNotNull()
    joined = joined.withColumn("_removed", F.when(cut, F.size("__dedup_gone")).otherwise(F.lit(0)).cast("bigint"))
    return joined.withColumn(text, F.when(cut, rest).otherwise(F.col(text))).drop("__dedup_cut", "__dedup_lines", "__dedup_gone")
