"""Language identification with a byte convolutional network."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.convnet import ByteConvNet, windows_of

WINDOW = 128
UNKNOWN = "und"

# A model is fitted on at most so many languages (the most frequent) and about so many windows of each.
MAX_LANGUAGES = 200
SAMPLE_PER_LANGUAGE = 1200


def sample_windows(docs: DataFrame, text: str, lang: str, key: str, per_language: int, window: int) -> DataFrame:
    """About ``per_language`` windows of each language: columns window, lang.

    Rows are drawn by a hash of their key, the rate of a language following from its exact count, and a window's
    place in its text by another hash. The sample is the same on every run and has a bounded size.
    """
    known = docs.where(F.col(lang).isNotNull() & F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}"))
    counts = known.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MAX_LANGUAGES).collect()
    rate = F.create_map(*[F.lit(v) for r in counts for v in (r[0], per_language / r[1])])[F.col(lang)] if counts else F.lit(0.0)
    draw = F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1_000_000)) / 1_000_000
    span = F.greatest(F.length(text) - window, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.lit("start"), key), span.cast("long")) + 1
    return known.where(draw < rate).select(
        F.col(text).substr(start.cast("int"), F.lit(window)).alias("window"), F.col(lang).alias("lang")
    )


def fit_language_model(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
    window: int = WINDOW,
) -> ByteConvNet | None:
    """Trains the network on labelled text.

    Rows without language, without text or without a letter teach nothing. ``per_language`` bounds what comes to the
    driver. Windows that repeat count once, so a group of copies does not outweigh the rest. Raises ValueError when
    no row is labelled.
    """
    found = sample_windows(docs, text, lang, key, per_language, window).limit(4 * per_language * MAX_LANGUAGES)
    pairs = sorted({(r.window, r.lang) for r in found.collect()})
    if not pairs:
        return None
    labels = sorted({p[1] for p in pairs})
    # Short texts are common, so each window is also seen as its first quarter and its first eighth.
    rows = [(t[:n].encode()[:window], labels.index(k)) for t, k in pairs for n in (window, window // 4, window // 8)]
    x, _ = windows_of([t for t, _ in rows], window)
    return ByteConvNet(labels).fit(x, np.array([y for _, y in rows]))


def language_column(model: ByteConvNet | None, text: str = "text", window: int = WINDOW) -> Column:
    """struct<lang_pred, score> of a text column: every window of the whole text is classified, and the mean of the
    windows' probabilities, weighted by their bytes, decides; the first label in order wins a tie. A null text and
    one without letters give ``und`` and score 0, and so does every text where there is no model."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def classify(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for start in range(0, len(texts), 64):
            block = [t.encode() if t else b"" for t in texts.slice(start, 64).to_pylist()]
            for p in probabilities(model, block, window):
                best = int(p.argmax())
                names.append(model.labels[best])
                scores.append(min(1.0, float(p[best])))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    has_letters = F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}")
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return unknown
    return F.when(has_letters, classify(F.when(has_letters, F.col(text)))).otherwise(unknown)


def probabilities(model: ByteConvNet, texts: list[bytes], window: int) -> np.ndarray:
    """Mean class probabilities of whole texts."""
    x, counts = windows_of(texts, window)
    ends = np.cumsum(counts)
    weight = np.full(len(x), float(window))
    weight[ends - 1] = [max(1, len(t) - (n - 1) * window) for t, n in zip(texts, counts, strict=True)]
    summed = np.add.reduceat(model.probabilities(x) * weight[:, None], ends - counts, axis=0)
    return summed / summed.sum(axis=1, keepdims=True)


def identify_languages(docs: DataFrame, model: ByteConvNet | None, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_language`` (lang_pred, score); rows, order and other columns stay."""
    return docs.withColumn("_language", language_column(model, text))
