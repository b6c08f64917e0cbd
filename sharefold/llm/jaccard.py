"""Exact n-gram Jaccard join by prefix lists, with skipping by set relations.

Sets that are equal are one class. A class's rarest shingles are its entries in the index lists. In every list a pivot
is compared with all members; what this tells about two members decides most pairs without looking at their sets
(answers derived from those of a similar set), and members already connected need no answer. Members that meet too
late in their prefixes are skipped by their places. Long lists are cut in blocks by size and place, and two blocks that
cannot hold a link are never brought together. Of the pairs that are left, those whose parities differ in too many bits
cannot link; only for the others are sets made and moved.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharefold.llm.components import components
from sharefold.llm.filters import HashFilter
from sharefold.llm.shingles import SKETCH_BITS, SLICES, digest, least_apart, parity, prefix_length, rarest_first, shingle_set, slots
from sharefold.session import scratch_path
from sharefold.sinks import pin

PERCENT = 85

# Members of a list that are walked together; a longer list is cut in blocks, and pairs of blocks are walked apart.
BLOCK = 2048

# Blocks of a long list hold sets whose sizes differ by less than this factor and whose places, as shares of a set, lie
# within this step.
SIZE_STEP = 1.03
PLACE_STEP = 0.03


def survey(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass: for each document its set's size and digest, and from each task counts of shingles by slot, up to 255."""

    def count(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint8)
        for batch in batches:
            keys, sizes, first, second = batch.column(0), [], [], []
            for value in batch.column(1):
                members = shingle_set(value.as_py())
                at = slots(members)
                np.add.at(sketch, at[sketch[at] < 255], 1)
                a, b = digest(members)
                sizes.append(len(members))
                first.append(a)
                second.append(b)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names,
            )
        for i, part in enumerate(np.split(sketch, SLICES)):
            if part.any():
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([i], pa.int32()), pa.array([part.tobytes()])], names)

    names = ["id", "n", "d1", "d2", "slice", "counts"]
    schema = "id bigint, n bigint, d1 bigint, d2 bigint, slice int, counts binary"
    return docs.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(count, schema)


def shingle_counts(surveyed: DataFrame) -> np.ndarray:
    """The sketch of all tasks, 2**SKETCH_BITS counters: its size does not depend on the data."""

    def total(parts: pa.Table) -> pa.Table:
        counts = np.zeros((1 << SKETCH_BITS) // SLICES, np.uint32)
        for c in parts["counts"]:
            counts += np.frombuffer(c.as_buffer(), np.uint8)
        return pa.table({"slice": parts["slice"][:1].cast(pa.int32()), "counts": [counts.tobytes()]})

    parts = surveyed.where(F.col("slice").isNotNull()).select("slice", "counts")
    summed = parts.groupBy("slice").applyInArrow(total, "slice int, counts binary").collect()
    sketch = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint32)
    for row in summed:
        sketch[row[0]] = np.frombuffer(row[1], np.uint32)
    return sketch.ravel()


def prefixes(docs: DataFrame, sketch: np.ndarray, percent: int, key: str, text: str) -> DataFrame:
    """id, n, digest (d1, d2), the rarest shingles, packed in one binary, and the parity of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    @F.arrow_udf("struct<n:bigint,d1:bigint,d2:bigint,prefix:binary,parity:binary>")
    def rarest(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            members = shingle_set(value.as_py())
            head = rarest_first(members, shared.value)[: prefix_length(len(members), percent)] if len(members) else members
            rows.append((len(members), *digest(members), head.astype(np.int64).tobytes(), parity(members)))
        names, types = ("n", "d1", "d2", "prefix", "parity"), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return docs.select(F.col(key).cast("bigint").alias("key"), rarest(F.col(text)).alias("r")).select("key", "r.n", "r.d1", "r.d2", "r.prefix", "r.parity")


def entries(packed: DataFrame) -> DataFrame:
    """Index entries: shingle, id, n, place."""

    def unpack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                heads = [np.frombuffer(b, np.int64) for b in part.column(2).to_pylist()]
                many = [len(h) for h in heads]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(heads)),
                        pa.array(np.repeat(part.column(0).to_numpy(), many)),
                        pa.array(np.repeat(part.column(1).to_numpy().astype(np.int32), many)),
                        pa.array(np.concatenate([np.arange(m, dtype=np.int32) for m in many])),
                    ],
                    ["shingle", "id", "n", "place"],
                )

    return packed.select("id", "n", "prefix").mapInArrow(unpack, "shingle bigint, id bigint, n int, place int")


def member_lists(listed: DataFrame) -> DataFrame:
    """Entries of the shingles that more than one class has, with their number (many) and the list's smallest id (pivot).

    Entries move once. By far most stand alone in their list, but which ones is only known where they meet, and a filter
    that would spare them a second move has to grow with them.
    """
    same = Window.partitionBy("shingle")
    return listed.withColumns({"many": F.count("*").over(same), "pivot": F.min("id").over(same)}).where("many > 1")


def common_column(a: str, b: str) -> Column:
    """How many shingles two packed sets have in common."""

    @F.arrow_udf("int")
    def common(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.searchsorted(p, q)
            at[at == len(p)] = 0
            out.append(int((p[at] == q).sum()))
        return pa.array(out, pa.int32())

    return common(F.col(a), F.col(b))


def reaches(common: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * common.cast("bigint") >= percent * (n.cast("bigint") + m - common)


def may_link(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, n, m) without those that the parities show to be too far apart; a pair that links is never left
    out. Unrelated sets differ in half of the bits, sets that link in a sixth at most."""

    @F.arrow_udf("bigint")
    def apart(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([least_apart(x.as_py(), y.as_py()) for x, y in zip(left, right, strict=True)], pa.int64())

    told = pairs
    for side, name in (("a", "_p"), ("b", "_q")):
        told = told.join(packed.select(F.col("id").alias(side), F.col("parity").alias(name)), side)
    told = told.withColumn("_most", F.floor((F.col("n") + F.col("m") - apart("_p", "_q")) / 2))
    return told.where(reaches(F.col("_most"), F.col("n"), F.col("m"), percent)).select(*pairs.columns)


def members_column(text: str) -> Column:
    """A text's set, packed, and the first half of its digest, which tells apart the texts of one key."""

    @F.arrow_udf("struct<d1:bigint,members:binary>")
    def members(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(t.as_py()) for t in texts]
        first = pa.array([digest(m)[0] for m in sets], pa.int64())
        return pa.StructArray.from_arrays([first, pa.array([m.tobytes() for m in sets], pa.binary())], ["d1", "members"])

    return members(F.col(text))


def compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """``pairs`` (a, b, n, m) of classes with ``common``, the number of shingles their sets have in common, and m of b.

    Sets are made of those documents only that stand for a class in a pair. A document is told by key and digest, so
    texts that share a key are kept apart. Sets are by far the widest rows here, so it is the pairs that are given the keys
    and digests of both sides: all sets move once, for both sides alike, and then once with each pair.
    """
    spark = docs.sparkSession
    pairs = pin(pairs, scratch_path(spark, "to-compare"))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    ids = pin(ids.join(classes, "id").select("id", F.col("rep").alias("key"), "d1"), scratch_path(spark, "to-compare"))
    known = HashFilter(ids.select(F.xxhash64("key").alias("h")), "h")
    wanted = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("_text")).where(known.likely(F.xxhash64("key")))
    made = wanted.select("key", members_column("_text").alias("r")).select("key", "r.d1", "r.members")
    sets = pin(made, scratch_path(spark, "sets"))
    named = pairs.select("a", "b", "n")
    for side in ("a", "b"):
        named = named.join(ids.select(F.col("id").alias(side), F.col("key").alias(f"_key_{side}"), F.col("d1").alias(f"_d1_{side}")), side)
    named = pin(named, scratch_path(spark, "to-compare"))
    left = sets.select(F.col("key").alias("_key_a"), F.col("d1").alias("_d1_a"), F.col("members").alias("_p"))
    right = sets.select(F.col("key").alias("_key_b"), F.col("d1").alias("_d1_b"), F.col("members").alias("_q"))
    both = named.join(left, ["_key_a", "_d1_a"]).join(right, ["_key_b", "_d1_b"]).withColumn("common", common_column("_p", "_q"))
    return both.select("a", "b", "n", (F.length("_q") / 8).cast("bigint").alias("m"), "common")


def star_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b, n, m) of members with the pivots they share most lists with, three at most.

    These are only the first links: pairs that are not among them are met when the lists are walked.
    """
    votes = lists.where("id <> pivot").groupBy(F.col("id").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("votes"), F.max("n").cast("bigint").alias("n"))
    # A set that reaches 85 of 100 shares some 7 of 100 shingles within the prefixes; half of that is worth a look.
    order = Window.partitionBy("a").orderBy(F.desc("votes"), "b")
    best = votes.where(1000 * F.col("votes") >= 34 * F.col("n")).withColumn("_at", F.row_number().over(order)).where("_at <= 3")
    return best.select("a", "b", "n", F.col("n").alias("m"))


def list_pairs(lists: dict[str, np.ndarray], percent: int) -> list[np.ndarray]:
    """Of sorted lists, the pairs that may link: a, b, n, m, sure. All lists are walked at once, entry against the
    next, then the one after, for as long as any list reaches.

    A pair is looked for in the list of the first shingle the two have in common. There they share at most what stands
    from that place on, and most pairs of a long list, meeting late in both prefixes, are left out at once.
    """
    group, found = lists["group"], []
    at, step = np.arange(len(group)), 0
    while len(at):
        step += 1
        at = at[: np.searchsorted(at, len(group) - step)]
        at = at[group[at] == group[at + step]]
        x, y = at, at + step
        nx, ny, ox, oy = lists["n"][x], lists["n"][y], lists["with_pivot"][x], lists["with_pivot"][y]
        most = np.minimum(nx - lists["place"][x], ny - lists["place"][y])
        known = (ox >= 0) & (oy >= 0)
        most = np.where(known, np.minimum(most, np.minimum(ox, oy) + np.minimum(nx - ox, ny - oy)), most)
        can = (100 * most >= percent * (nx + ny - most)) & (lists["comp"][x] != lists["comp"][y])
        can &= (lists["i"][x] == lists["j"][x]) | (lists["block"][x] != lists["block"][y])
        x, y, nx, ny = x[can], y[can], nx[can], ny[can]
        least = np.where(known, ox + oy - np.maximum(lists["pivot_n"][at], lists["pivot_n"][at + step]), 0)[can]
        sure = 100 * least >= percent * (nx + ny - least)
        swap = lists["id"][x] > lists["id"][y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        found.append((lists["id"][x], lists["id"][y], lists["n"][x], lists["n"][y], sure))
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def dealt_lists(lists: DataFrame, percent: int) -> DataFrame:
    """``lists`` with the walks (i, j) each member takes part in and its own ``block``.

    A short list is one walk. The members of a long one are dealt to cells by set size and place, and cells of more than
    BLOCK members to blocks. What a cell's sets can share at most (their shingles from the first place on) and how small
    they are bounds every link between two cells. Pairs of cells below the bound, and those whose members are all
    connected already, are left out; only members of the others are brought together.
    """
    zero = F.lit(0).cast("bigint")
    short = lists.where(F.col("many") <= BLOCK).withColumns({"i": zero, "j": zero, "block": zero})
    size, place = F.floor(F.log("n") / math.log(SIZE_STEP)), F.floor(F.col("place") / F.col("n") / PLACE_STEP)
    long = lists.where(F.col("many") > BLOCK).withColumn("cell", (size * 64 + place).cast("bigint"))
    bounds = long.groupBy("shingle", "cell").agg(
        F.ceil(F.count("*") / BLOCK).alias("parts"),
        F.max(F.col("n") - F.col("place")).alias("most"),
        F.min("n").alias("least"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
    )
    cells = pin(bounds, scratch_path(lists.sparkSession, "cells"))
    x, y = cells.alias("x"), cells.alias("y")
    both = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.cell") <= F.col("y.cell")))
    common = F.least("x.most", "y.most").cast("bigint")
    can = 100 * common >= percent * (F.col("x.least").cast("bigint") + F.col("y.least") - common)
    apart = F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi")

    def block(cell: str, part: str) -> Column:
        return F.col(cell) * (1 << 32) + F.col(part)

    walks = (
        both.where(can & apart)
        .select(F.col("x.shingle").alias("shingle"), F.col("x.cell").alias("p"), F.col("y.cell").alias("q"), F.col("x.parts").alias("ps"), F.col("y.parts").alias("qs"))
        .withColumn("s", F.explode(F.sequence(zero, F.col("ps") - 1)))
        .withColumn("t", F.explode(F.sequence(zero, F.col("qs") - 1)))
        .where("p < q or s <= t")
        .select("shingle", block("p", "s").alias("i"), block("q", "t").alias("j"))
    )
    sides = walks.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    parted = long.join(cells.select("shingle", "cell", "parts"), ["shingle", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    parted = parted.withColumn("block", block("cell", "part"))
    return short.unionByName(parted.join(sides, ["shingle", "block"]).select(*short.columns))


def walk_lists(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n, m, sure) of list members in different components that may link; ``sure`` ones do.

    ``lists`` has shingle, many, id, n, place, comp, pivot_n, with_pivot (shingles in common with the list's pivot, -1
    where not compared). Two blocks of a long list are walked apart (``dealt_lists``), so no task holds more than two.
    """
    columns = ("shingle", "i", "j", "block", "id", "n", "place", "comp", "pivot_n", "with_pivot")

    def walk(batches):
        rest = None
        for batch in chain(batches, [None]):
            own = None if batch is None else {c: batch.column(c).to_numpy().astype(np.int64) for c in columns}
            if rest is not None and own is not None:
                own = {c: np.concatenate([rest[c], own[c]]) for c in columns}
            elif own is None:
                own = rest
            if own is None or not len(own["id"]):
                continue
            new = np.ones(len(own["id"]), bool)
            new[1:] = (own["shingle"][1:] != own["shingle"][:-1]) | (own["i"][1:] != own["i"][:-1]) | (own["j"][1:] != own["j"][:-1])
            # The last list may go on in the next batch.
            whole = len(new) if batch is None else int(np.flatnonzero(new)[-1])
            rest = None if batch is None else {c: own[c][whole:] for c in columns}
            if whole:
                ready = {c: own[c][:whole] for c in columns} | {"group": np.cumsum(new[:whole])}
                parts = list_pairs(ready, percent)
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["a", "b", "n", "m", "sure"])

    dealt = dealt_lists(lists, percent)
    ordered = dealt.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "id")
    return ordered.select(*columns).mapInArrow(walk, "a bigint, b bigint, n bigint, m bigint, sure boolean")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: the key, n_shingles, component_id (smallest key reachable by links).

    Links are exact: 100 * common >= percent * union. Documents without words, null text among them, link with nothing.
    Equal sets are one class; its members are linked with each other. Keys are whole numbers; rows that repeat a key are rows of
    their own with equal or different sets, and all their links count. A null key gets a null component unless its class
    has a key.
    """
    spark = docs.sparkSession
    surveyed = pin(survey(docs, key, text), scratch_path(spark, "survey"))
    base = surveyed.where(F.col("slice").isNull()).select("id", "n", "d1", "d2")
    # Classes are numbered: a key does not tell them apart where it is repeated with another text. Numbers follow the keys, so
    # a pivot is a list's earliest document, mostly the one that others were copied from.
    classes = base.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")).orderBy("rep", "n", "d1")
    classes = pin(classes.withColumn("id", F.monotonically_increasing_id()), scratch_path(spark, "classes"))
    # Two sets that differ share at most n - 1 of n shingles, so small ones link with equal ones only.
    least = next(n for n in range(1, 1000) if 100 * n >= percent * (n + 1))
    told_by = ["key", "n", "d1", "d2"]
    reps = classes.where((F.col("n") >= least) & F.col("rep").isNotNull()).select("id", F.col("rep").alias("key"), "n", "d1", "d2")
    packed = prefixes(docs, shingle_counts(surveyed), percent, key, text).where(F.col("n") >= least)
    packed = pin(packed.join(reps, told_by).dropDuplicates(told_by).select("id", "n", "prefix", "parity"), scratch_path(spark, "prefixes"))
    lists = pin(member_lists(entries(packed)), scratch_path(spark, "lists"))

    answers = pin(compared(star_pairs(lists), docs, classes, key, text), scratch_path(spark, "answers"))
    sure = answers.where(reaches(F.col("common"), F.col("n"), F.col("m"), percent)).select("a", "b")
    comps = pin(components(sure), scratch_path(spark, "components"))

    # Lists whose members are all connected have no more to tell.
    placed = lists.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = placed.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("shingle")
    told = answers.select(F.col("a").alias("id"), F.col("b").alias("pivot"), "common", F.col("m").alias("pivot_n"))
    open_lists = (
        placed.join(mixed, "shingle")
        .join(told, ["id", "pivot"], "left")
        .withColumn("pivot_n", F.when(F.col("id") == F.col("pivot"), F.col("n")).otherwise(F.col("pivot_n")))
        .withColumn("with_pivot", F.when(F.col("id") == F.col("pivot"), F.col("n")).otherwise(F.coalesce("common", F.lit(-1))))
        .select("shingle", "many", "id", "n", "place", "comp", F.coalesce("pivot_n", F.lit(0)).cast("bigint").alias("pivot_n"), "with_pivot")
    )
    pairs = walk_lists(open_lists, percent).groupBy("a", "b").agg(F.max("sure").alias("sure"), F.max("n").alias("n"), F.max("m").alias("m"))
    done = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = pin(pairs.join(done, ["a", "b"], "left_anti"), scratch_path(spark, "pairs"))
    open_pairs = may_link(pairs.where("not sure").select("a", "b", "n", "m"), packed, percent)
    checked = compared(open_pairs, docs, classes, key, text)
    checked = checked.where(reaches(F.col("common"), F.col("n"), F.col("m"), percent))
    tied = comps.select(F.col("id").alias("a"), F.col("comp").alias("b"))
    links = tied.union(pairs.where("sure").select("a", "b")).union(checked.select("a", "b"))
    joined = pin(components(links), scratch_path(spark, "components"))

    # The smallest number of a component is that of its smallest key.
    first = joined.where("id = comp").join(classes, "id").select("comp", F.col("rep").alias("component_id"))
    linked = joined.join(pin(first, scratch_path(spark, "first")), "comp").select("id", "component_id")
    of_class = classes.join(linked, "id", "left").select("n", "d1", "d2", F.coalesce("component_id", "rep").alias("component_id"))
    out = base.join(of_class, ["n", "d1", "d2"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents whose key is the smallest of their component, all columns as they are."""
    parts = jaccard_components(docs, key, text, percent)
    gone = parts.where(F.col("component_id") < F.col(key)).select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key] == F.col("__gone"), "left_anti")
