"""Toxicity by a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.filters import HashFilter

# Sizes of the n-grams, and log2 of the buckets they are hashed to: the model's size does not grow with the text.
SIZES = (3, 4, 5)
BITS = 18

# A bucket is a feature where its ratio is so many standard errors from even, and the surest of these are taken.
MIN_CERTAINTY = 4.0
MAX_FEATURES = 1 << 14

# The weights are fitted on about so many labelled texts of each class; the ratios are counted over all of them.
SAMPLE_PER_CLASS = 2000

# Code points that are hashed at a time, so that a very long text needs no more memory than this.
STRETCH = 1 << 18

_BASE, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


class NgramReader:
    """The distinct buckets of the n-grams of a whole text, in lower case. ``wanted`` leaves out all other buckets."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted = wanted
        self.seen = np.zeros(1 << BITS, dtype=bool)

    def read(self, text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        # Neighbouring stretches share what an n-gram over their border needs.
        for start in range(0, max(len(points), 1), STRETCH):
            self._mark(points[start : start + STRETCH + SIZES[-1] - 1])
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found

    def _mark(self, points: np.ndarray) -> None:
        rolled = points
        for size in range(2, SIZES[-1] + 1):
            rolled = rolled[:-1] * _BASE + points[size - 1 :]
            if size in SIZES:
                buckets = ((rolled + np.uint64(size)) * _SPREAD) >> np.uint64(64 - BITS)
                if self.wanted is not None:
                    buckets = buckets[self.wanted[buckets]]
                self.seen[buckets] = True


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` by bucket (0 for those that are no feature) and the score's offset, both on the logit scale."""

    weights: np.ndarray
    offset: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        reader = NgramReader(self.weights != 0)
        logits = np.array([self.offset + self.weights[reader.read(t)].sum() for t in texts])
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500)))


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, *more: str) -> DataFrame:
    """_key, _text, _toxic (0 or 1) and ``more`` of documents with a label. Labels that repeat a key are one: the largest."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    known = known.agg(F.max(F.col(label)).cast("int").alias("_toxic"))
    # Texts without a label are many; a filter of fixed size keeps nearly all of them out of the shuffle. Labels grow with
    # the corpus, so they are merged at every size and never broadcast.
    listed = HashFilter(known.select(F.xxhash64(F.col("_key")).alias("hash")), "hash")
    return docs.where(listed.likely(F.xxhash64(F.col(key)))).select(F.col(key).alias("_key"), F.col(text).alias("_text"), *more).join(known.hint("merge"), "_key")


def class_counts(rows: DataFrame) -> DataFrame:
    """In how many texts of each class a bucket occurs: bucket, n0, n1. Bucket -1 counts the texts themselves. A task
    sends a row per bucket at most, and the result has no more rows than there are buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen, texts = NgramReader(), np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                seen[toxic.as_py(), reader.read(text.as_py())] += 1
                texts[toxic.as_py()] += 1
        used = np.flatnonzero(seen.any(axis=0))
        columns = [np.append(used, -1), *(np.append(seen[k, used], texts[k]) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "n0", "n1"])

    per_task = rows.select("_text", "_toxic").mapInArrow(count, "bucket bigint, n0 bigint, n1 bigint")
    return per_task.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def log_count_ratios(counts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each bucket, 0 for those that are no feature, and the number of texts of each class.

    The smoothing is one text, shared between the classes by their sizes, so an unseen bucket has an even ratio.
    """
    bucket, n0, n1 = (counts.column(c).to_numpy() for c in ("bucket", "n0", "n1"))
    texts = np.array([n0[bucket < 0].sum(), n1[bucket < 0].sum()], float)
    ratios = np.zeros(1 << BITS)
    if not texts.all():
        return ratios, texts
    own = bucket >= 0
    share = texts / texts.sum()
    a, b = n1[own] + share[1], n0[own] + share[0]
    ratio = np.log(a / (texts[1] + share[1])) - np.log(b / (texts[0] + share[0]))
    certainty = np.abs(ratio) / np.sqrt(1 / a + 1 / b)
    surest = np.lexsort((bucket[own], -certainty))[:MAX_FEATURES]
    surest = surest[certainty[surest] >= MIN_CERTAINTY]
    ratios[bucket[own][surest]] = ratio[surest]
    return ratios, texts


def _fit(sample: pa.Table, ratios: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression over the scaled features by Nesterov's gradient steps. A text weighs as many texts as it
    stands for, ``share`` being the drawn part of its class."""
    features = np.flatnonzero(ratios)
    slot = np.zeros(len(ratios), np.int32)
    slot[features] = np.arange(len(features))
    toxic = sample.column("_toxic").to_numpy().astype(np.int64)
    found = sample.column("found").combine_chunks()
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), found.value_lengths().to_numpy(zero_copy_only=False))
    column = slot[found.flatten().to_numpy(zero_copy_only=False)]
    value = ratios[features][column]
    weight = sample.column("count").to_numpy() / share[toxic]
    weight /= weight.sum()
    prior = float((weight * toxic).sum())
    squares = np.bincount(row, value * value, len(toxic))
    step = 1.0 / (0.25 * (squares.max(initial=0.0) + 1.0) + 1e-4)
    w, b = np.zeros(len(features)), np.log(prior / (1 - prior))
    ahead_w, ahead_b = w, b
    for k in range(800):
        logits = np.bincount(row, ahead_w[column] * value, len(toxic)) + ahead_b
        error = weight * (1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500))) - toxic)
        next_w = ahead_w - step * (np.bincount(column, error[row] * value, len(features)) + 1e-4 * ahead_w)
        next_b = ahead_b - step * error.sum()
        momentum = k / (k + 3)
        ahead_w, ahead_b = next_w + momentum * (next_w - w), next_b + momentum * (next_b - b)
        w, b = next_w, next_b
    weights = np.zeros(len(ratios))
    weights[features] = w * ratios[features]
    return weights, float(b)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
) -> ToxicityModel:
    """Learns from the documents that ``labels`` marks with 0 or 1; other labels, null ones and null keys teach nothing.

    The ratios are counted over all labelled texts, each n-gram once a text. The weights come from about ``per_class``
    texts of each class, drawn by a hash of the text, so copies are drawn together and every run draws the same; of
    these only the features come to the driver, MAX_FEATURES a text at most. With no text of one class the model says
    the other class for every text, and 0 where nothing is labelled.
    """
    rows = _labelled(docs, labels, key, text, label)
    ratios, texts = log_count_ratios(class_counts(rows).toArrow())
    if not texts.all():
        return ToxicityModel(np.zeros(1 << BITS), 500.0 if texts[1] else -500.0)
    share = np.minimum(1.0, per_class / texts)
    wanted = rows.sparkSession.sparkContext.broadcast(ratios != 0)

    @F.arrow_udf("array<int>")
    def features(values: pa.Array) -> pa.Array:
        reader = NgramReader(wanted.value)
        return pa.array([reader.read(t).astype(np.int32) for t in values.to_pylist()], pa.list_(pa.int32()))

    draw = F.pmod(F.xxhash64(F.lit("draw"), F.coalesce(F.col(text), F.lit(""))), F.lit(1_000_000)) / 1_000_000
    # Texts that no class draws stay out of this second join.
    drawn = _labelled(docs.where(draw < float(share.max())).withColumn("_draw", draw), labels, key, text, label, "_draw")
    drawn = drawn.where(F.col("_draw") < F.when(F.col("_toxic") == 1, float(share[1])).otherwise(float(share[0])))
    sample = drawn.select("_toxic", features("_text").alias("found")).groupBy("_toxic", "found").count().toArrow()
    # The sum over texts is one of floats: a fixed order makes every run's weights the same.
    order = sorted(range(len(sample)), key=lambda i: (sample["_toxic"][i].as_py(), sample["found"][i].values.to_numpy().tobytes()))
    weights, offset = _fit(sample.take(order), ratios, share)
    return ToxicityModel(weights, offset)


def toxicity_column(spark, model: ToxicityModel, text: str = "text") -> Column:
    """Score from 0 to 1 of a text column; null counts as empty. The weights reach the tasks by broadcast: 2**BITS
    numbers, whatever the data."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.scores(texts.slice(start, 64).to_pylist()) for start in range(0, len(texts), 64)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "_toxicity") -> DataFrame:
    """``docs`` with the score in the column ``out``, which must be new; all rows and other columns stay. Repeated
    rows get the same score, null and empty texts that of no feature."""
    if out in docs.columns:
        raise ValueError(f"the documents have a column {out} already")
    return docs.withColumn(out, toxicity_column(docs.sparkSession, model, text))
