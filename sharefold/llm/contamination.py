"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.filters import HashFilter
from sharefold.session import scratch_path
from sharefold.sinks import pin

# The token places each mask compares, within SPAN tokens; the other places may differ. Wherever two of the
# tokens of a window of MIN_WORDS are replaced, one of the masks at one of its places meets neither: all 78 placings.
SPAN = 8
MASKS = (
    (0, 1, 2, 4, 6, 7),
    (0, 1, 4, 5, 6, 7),
)

# Items with fewer tokens than SPAN, from so many on, are found where they stand word for word.
LEAST_WORDS = 5

# An overlap is a window of MIN_WORDS aligned tokens (all of a shorter item) of which MIN_SHARE are equal.
MIN_WORDS = 13
MIN_SHARE = 0.8

# Log2 of the bits in the filter that spares a shuffle of seeds no item has. It bounds what is sent to the executors
# (2**23 bits: 1 MB), whatever the size of the benchmark; a fuller filter only lets more seeds through.
FILTER_BITS = 23


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a whole text; null has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, key: str, short: list[int], items: bool = False) -> DataFrame:
    """Each seed of each place: key, pos (from 0), seed, its ``span``, and the hashes ``near`` it, with ``lead`` of them before it.

    ``rows`` has the key and ``hashes``. Besides the masks there is a seed of all tokens for each length in ``short``;
    of an item only that of its own length.
    """
    reach, least = MIN_WORDS - SPAN, min([SPAN, *short])
    size = F.size("hashes")
    places = rows.where(size >= least).select(key, "hashes", F.explode(F.sequence(F.lit(0), size - least)).alias("pos"))
    at = [F.get("hashes", F.col("pos") + i) for i in range(SPAN)]

    def seed(number: int, span: int, tokens: tuple[int, ...], own: Column) -> Column:
        return F.when(own & (F.col("pos") + span <= size), F.struct(F.xxhash64(F.lit(number), *[at[i] for i in tokens]).alias("seed"), F.lit(span).alias("span")))

    found = [seed(n, SPAN, mask, F.lit(True)) for n, mask in enumerate(MASKS)]
    found += [seed(-n, n, tuple(range(n)), size == n if items else F.lit(True)) for n in short]
    lead = F.least(F.col("pos"), F.lit(reach))
    near = F.slice("hashes", F.col("pos") - lead + 1, lead + SPAN + reach)
    each = places.select(key, "hashes", "pos", F.explode(F.array(*found)).alias("s")).where(F.col("s").isNotNull())
    return each.select(key, "pos", "s.seed", "s.span", lead.alias("lead"), near.alias("near"), size.alias("size"))


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row for each document and item that share a passage: both keys, n_seeds, similarity, first_word, last_word.

    Seeds of all places of all documents are held against the items' seeds: first the fixed-size filter, then a join
    on the seed. Around each common seed, the aligned windows of MIN_WORDS tokens (all tokens of a shorter item) that hold
    it are compared token by token, and the best must reach MIN_SHARE. A window of MIN_WORDS with up to two tokens replaced is
    always found. A shorter item is found word for word, and with a token replaced where a mask passes over it; one with
    fewer than SPAN tokens only word for word, and one with fewer than LEAST_WORDS never. ``n_seeds`` counts the seeds that
    pass, ``similarity`` is the best share, ``first_word`` and ``last_word`` bound the seeds in the document. Null and empty
    texts share nothing. A null key is a key. Other columns are not read. Rows that repeat a key are taken together.
    """
    hashed = items.select(F.col(item_key).alias("_item"), token_hashes(F.col(text)).alias("hashes"))
    # At most SPAN - LEAST_WORDS numbers: the lengths of short items that there are.
    size = F.size("hashes")
    short = sorted(r.n for r in hashed.where((size >= LEAST_WORDS) & (size < SPAN)).select(size.alias("n")).distinct().collect())
    item_seeds = seeds(hashed, "_item", short, items=True)
    # Written out first, so that Spark knows their size when it chooses the join.
    item_seeds = pin(item_seeds, scratch_path(docs.sparkSession, "item-seeds"))
    known = HashFilter(item_seeds, "seed", filter_bits)
    doc_seeds = seeds(docs.select(F.col(doc_key).alias("_doc"), token_hashes(F.col(text)).alias("hashes")), "_doc", short)
    likely = doc_seeds.where(known.likely(F.col("seed")))
    hits = likely.select("_doc", "pos", "seed", F.col("lead").alias("dl"), F.col("near").alias("dn")).join(
        item_seeds.select("_item", "seed", "span", F.col("lead").alias("il"), F.col("near").alias("ir"), "size"), "seed"
    )
    long = F.least(F.lit(MIN_WORDS), F.col("size"))

    def equal(shift: int) -> Column:
        same = lambda k: F.get("dn", F.col("dl") - shift + k) == F.get("ir", F.col("il") - shift + k)
        count = F.aggregate(F.sequence(F.lit(0), long - 1), F.lit(0), lambda n, k: n + F.coalesce(same(k), F.lit(False)).cast("int"))
        # Items shorter than a window have fewer places for it around the seed.
        return F.when(F.lit(shift) <= long - F.col("span"), count).otherwise(F.lit(0))

    judged = hits.withColumn("equal", F.greatest(*[equal(s) for s in range(MIN_WORDS - SPAN + 1)])).withColumn("share", F.col("equal") / long)
    return (
        judged.where(F.col("share") >= MIN_SHARE)
        .groupBy("_doc", "_item")
        .agg(
            F.count("*").alias("n_seeds"),
            F.max("share").alias("similarity"),
            F.min("pos").cast("bigint").alias("first_word"),
            (F.max(F.col("pos") + F.col("span")) - 1).cast("bigint").alias("last_word"),
        )
        .withColumnsRenamed({"_doc": doc_key, "_item": item_key})
    )


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that share no passage with any item, all columns as they are."""
    found = overlaps(docs, items, key, text=text).select(F.col(key).alias("__hit")).distinct()
    return docs.join(found, docs[key].eqNullSafe(F.col("__hit")), "left_anti")
