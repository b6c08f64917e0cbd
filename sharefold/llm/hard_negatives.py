"""Hard-negative mining with Kronecker-packed integer products.

Components are integers. Several candidates are packed into the fields of one wide integer for each component, biased
so that no field is negative; one multiplication by an anchor's component then serves all of them, and after the sum
over the components every field holds one exact score. Fields are as wide as the largest sum there can be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharefold.session import scratch_path
from sharefold.sinks import pin

# Anchors are held against all rows in blocks of about so many, and candidates within a task so many at a time.
ANCHOR_BLOCK = 4096
CANDIDATE_BLOCK = 512

# Doubles hold integers of so many bits exactly, so BLAS multiplies such wide integers. Wider ones are Python's own.
EXACT_BITS = 53
WIDE_FIELDS = 4

_NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Packing:
    """Fields for vectors of ``size`` components of at most ``bound`` in absolute value."""

    size: int
    bound: int

    @property
    def width(self) -> int:
        """Bits of a field: what a sum of ``size`` products of two biased components needs."""
        return max(1, (self.size * (2 * self.bound) ** 2).bit_length())

    @property
    def fields(self) -> int:
        return EXACT_BITS // self.width or WIDE_FIELDS

    @property
    def exact(self) -> bool:
        return self.width <= EXACT_BITS

    def anchors(self, components: np.ndarray) -> np.ndarray:
        """Biased anchors, one a column."""
        return (components + self.bound).T.astype(np.float64 if self.exact else object)

    def scores(self, candidates: np.ndarray, anchors: np.ndarray, anchor_sums: np.ndarray) -> np.ndarray:
        """Inner products of all candidates (rows) with all anchors (columns of ``anchors``)."""
        n, fields, width = len(candidates), self.fields, self.width
        groups = -(-n // fields)
        biased = np.zeros((groups * fields, self.size), np.int64)
        biased[:n] = candidates + self.bound
        wide = biased[:groups].astype(np.float64 if self.exact else object)
        for k in range(1, fields):
            wide = wide + biased[k * groups : (k + 1) * groups].astype(wide.dtype) * (1 << (k * width))
        products = wide @ anchors
        if self.exact:
            products = products.astype(np.int64)
        mask = (1 << width) - 1
        parts = [(products >> (k * width)) & mask for k in range(fields)]
        found = np.concatenate(parts)[:n]
        # (a + b)(c + b) = ac + b(a + c + b), summed over the components.
        bias = self.bound * (anchor_sums[None, :] + candidates.sum(axis=1)[:, None] + self.size * self.bound)
        return (found - bias).astype(np.int64)


class Best:
    """The first ``k`` entries of each group by score from high to low, then id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.ident = (np.zeros(0, np.int64) for _ in range(3))
        self.last_score, self.last_ident = np.full(groups, _NONE), np.full(groups, np.iinfo(np.int64).max)

    def offer(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        last = self.last_score[group]
        better = (score > last) | ((score == last) & (ident < self.last_ident[group]))
        if not better.any():
            return
        group = np.concatenate([self.group, group[better]])
        score = np.concatenate([self.score, score[better]])
        ident = np.concatenate([self.ident, ident[better]])
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
        keep = rank < self.k
        full = rank == self.k - 1
        self.last_score[group[full]], self.last_ident[group[full]] = score[full], ident[full]
        self.group, self.score, self.ident = group[keep], score[keep], ident[keep]


@dataclass(frozen=True)
class Anchors:
    """A block of anchors; ``of`` names each pair's anchor, ``low`` and ``high`` bound its negatives' scores."""

    packing: Packing
    ident: np.ndarray
    label: np.ndarray
    components: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _matrix(vectors: pa.Array, size: int, scale: int) -> np.ndarray:
    """Scaled components, shorter vectors filled up with 0."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    if (lengths == size).all():
        return flat.reshape(len(vectors), size)
    out = np.zeros((len(vectors), size), np.int64)
    out[np.arange(size)[None, :] < lengths[:, None]] = flat
    return out


def _scored(batches: Iterator[pa.RecordBatch], block: Anchors, scale: int):
    """Ids, labels and scores against all anchors, CANDIDATE_BLOCK candidates at a time."""
    anchors, sums = block.packing.anchors(block.components), block.components.sum(axis=1)
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATE_BLOCK):
            part = batch.slice(start, CANDIDATE_BLOCK)
            ident, label = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            yield ident, label, block.packing.scores(_matrix(part.column(2), block.packing.size, scale), anchors, sums)


def _rows(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (best.group, best.score, best.ident)], names=["at", "score", "id"])


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each ``at`` over all tasks, with their ``rank``. Each task sends ``k`` a group at most."""
    order = Window.partitionBy("at").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(vectors: DataFrame, shared, scale: int, k: int) -> DataFrame:
    """at (anchor of the block), score, id, rank: each anchor's best other rows of its label."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        best = Best(len(block.ident), k)
        for ident, label, scores in _scored(batches, block, scale):
            fits = (label[:, None] == block.label[None, :]) & (scores >= best.last_score[None, :])
            fits &= ident[:, None] != block.ident[None, :]
            row, at = np.nonzero(fits)
            best.offer(at, scores[row, at], ident[row])
        yield _rows(best)

    return _first(vectors.mapInArrow(find, "at bigint, score bigint, id bigint"), k)


def _negatives(vectors: DataFrame, shared, scale: int, k: int) -> DataFrame:
    """at (pair of the block), score, id, rank: each pair's best rows of other labels between its bounds."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        best = Best(len(block.of), k)
        n = len(block.ident)
        first = np.searchsorted(block.of, np.arange(n + 1))
        high = np.full(n, _NONE)
        np.maximum.at(high, block.of, block.high)
        for ident, label, scores in _scored(batches, block, scale):
            low = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(low, block.of, np.maximum(block.low, best.last_score))
            fits = (scores >= low[None, :]) & (scores <= high[None, :]) & (label[:, None] != block.label[None, :])
            row, anchor = np.nonzero(fits)
            score, own = scores[row, anchor], ident[row]
            for j in range(int(np.diff(first).max(initial=0))):
                pair = first[anchor] + j
                there = pair < first[anchor + 1]
                pair, s, i = pair[there], score[there], own[there]
                inside = (s >= block.low[pair]) & (s <= block.high[pair])
                best.offer(pair[inside], s[inside], i[inside])
        yield _rows(best)

    return _first(vectors.mapInArrow(find, "at bigint, score bigint, id bigint"), k)


def _share(scores: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent * score / 100, rounded up or down, without leaving 64 bits."""
    whole, rest = scores // 100, scores % 100
    return percent * whole + (-(-percent * rest // 100) if up else percent * rest // 100)


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """_id, _label and _vector of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return rows.select(F.col(key).cast("bigint").alias("_id"), F.col(label).cast("bigint").alias("_label"), F.col(vector).alias("_vector"))


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``is_anchor`` (a
    condition on the key) holds.

    A component is floor(``scale`` x), a score the inner product of two rows; higher scores come first, then smaller
    ids. For an anchor and each of its first ``n_positives`` other rows of the same label come the first ``n_negatives`` rows
    of other labels with a score from ``low_percent`` to ``high_percent`` of the positive's. Keys and labels are integers.

    Rows with a null key, label or vector, or with a component that is null or not finite, take no part. A shorter
    vector is filled up with 0. A row that is repeated counts each time as a candidate and once as an anchor; no row is
    a partner of its own id. Ties go to the smaller id. Other columns are not read. No anchor, no row. Vectors whose
    scores could leave 62 bits are refused with a ValueError.

    Anchors go block by block to the tasks, a block by broadcast (``anchor_block`` times the vector's size), and every block is held
    against all rows where they lie: rows are not shuffled. A task sends at most ``n_negatives`` rows a pair. Each block's result
    is written before the next begins.
    """
    rows = usable(vectors, key, vector, label)
    spark = rows.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    scaled = lambda x: F.floor(x.cast("double") * scale)
    span = rows.agg(
        F.max(F.size("_vector")).alias("size"),
        F.max(F.greatest(F.abs(scaled(F.array_min("_vector"))), F.abs(scaled(F.array_max("_vector"))))).alias("bound"),
    ).head()
    if span.size is None:
        return spark.createDataFrame([], schema)
    packing = Packing(span.size, int(span.bound or 0))
    if packing.size * packing.bound**2 >= 1 << 62:
        raise ValueError(f"components up to {packing.bound} give scores beyond 62 bits")
    path = scratch_path(spark, "hard-negatives")
    wanted = usable(vectors.where(is_anchor), key, vector, label).distinct()
    anchors = pin(wanted.withColumn("_hash", F.xxhash64("_id", "_label", "_vector")), f"{path}/anchors")
    blocks = -(-anchors.count() // anchor_block)
    for b in range(blocks):
        own = anchors.where(F.pmod("_hash", F.lit(blocks)) == b).orderBy("_id", "_hash").toArrow()
        block = _block(own, packing, scale)
        shared = spark.sparkContext.broadcast(block)
        # No more rows than ``n_positives`` for each anchor of the block.
        found = _positives(rows, shared, scale, n_positives).orderBy("at", "rank").toArrow()
        of, score, ident = (found.column(c).to_numpy() for c in ("at", "score", "id"))
        low, high = _share(score, low_percent, True), _share(score, high_percent, False)
        paired = spark.sparkContext.broadcast(_block(own, packing, scale, of, low, high))
        pairs = pa.table({"at": np.arange(len(of)), "anchor_id": block.ident[of], "positive_id": ident, "positive_score": score})
        negatives = _negatives(rows, paired, scale, n_negatives)
        result = negatives.join(spark.createDataFrame(pairs), "at").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        result.write.mode("overwrite").parquet(f"{path}/found/block={b}")
        shared.unpersist()
        paired.unpersist()
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/found")


def _block(rows: pa.Table, packing: Packing, scale: int, of=None, low=None, high=None) -> Anchors:
    none = np.zeros(0, np.int64)
    ident, label = (rows.column(c).to_numpy() for c in ("_id", "_label"))
    components = _matrix(rows.column("_vector").combine_chunks(), packing.size, scale)
    return Anchors(packing, ident, label, components, *(none if x is None else x for x in (of, low, high)))
