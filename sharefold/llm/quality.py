"""Host-level quality rules: rule failures by domain, rates shrunk by an empirical beta prior, verdicts joined back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
WINDOW = 8

# A host is dropped when its shrunk share of failing documents is above this.
MAX_FAILING = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in some window of ``window`` words (a power of two) which the text holds twice or more. Windows
    are numbered exactly, by numbering pairs of half-windows."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    a = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    half, many = 1, None
    while half < window:
        pair = a[:-half] * (int(a.max()) + 1) + a[half:]
        _, a, many = np.unique(pair, return_inverse=True, return_counts=True)
        if len(many) == len(a):  # all different already, so longer windows are too
            return 0
        half *= 2
    edge = np.zeros(len(words) + 1, np.int64)
    start = np.flatnonzero(many[a] > 1)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text; a null text has none of anything."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    seen, repeats = set(), 0
    for line in raw.split(b"\n"):
        if line.strip(SPACE):
            repeats += line in seen
            seen.add(line)
    spaces = sum(raw.count(SPACE[i : i + 1]) for i in range(len(SPACE)))
    symbols = sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return len(words), len(text or "") - spaces, symbols, repeats, repeated_words(words)


def counts_column(text: str = "text") -> Column:
    """COUNTS of a text column, as a struct."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def counts(texts: pa.Array) -> pa.Array:
        rows = [text_counts(t.as_py()) for t in texts]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
        return pa.StructArray.from_arrays(columns, list(COUNTS))

    return counts(F.col(text))


def rules() -> dict[str, Column]:
    """Rules over COUNTS; each is true where a document fails it."""
    c = {n: F.col(n) for n in COUNTS}
    return {
        "short": c["n_words"] < 20,
        "repeats": 100 * c["n_repeat_words"] > 30 * c["n_words"],
        "symbols": 10 * c["n_symbols"] > c["n_words"],
        "lines": 2 * c["n_dup_lines"] > F.greatest(c["n_words"] / 20, F.lit(1)),
        "word_length": (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"]),
    }


def measure(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Counts of every document: the key, ``_host`` and COUNTS. A host that is null or empty is no host."""
    named = F.nullif(F.col(host).cast("string"), F.lit(""))
    return docs.select(key, named.alias("_host"), counts_column(text).alias("_c")).select(key, "_host", "_c.*")


def host_verdicts(counted: DataFrame, max_failing: float = MAX_FAILING) -> DataFrame:
    """One row per host: _host, n_docs, failures of each rule, shrunk_rate, host_ok.

    The prior is fitted by moments: its mean is the rate over all documents, its weight follows from how far the
    rates of hosts differ beyond chance. Hosts with few documents are thus judged mostly by the others.
    """
    failed = F.lit(False)
    for rule in rules().values():
        failed = failed | rule
    hosts = (
        counted.where(F.col("_host").isNotNull())
        .groupBy("_host")
        .agg(
            F.count("*").alias("n_docs"),
            F.count_if(failed).alias("n_failing"),
            *[F.count_if(rule).alias(f"n_{name}") for name, rule in rules().items()],
        )
    )
    total, rate = F.sum("n_docs"), F.col("n_failing") / F.col("n_docs")
    sums = hosts.agg(
        (F.sum("n_failing") / total).alias("mean"),
        (F.sum(F.col("n_docs") * rate * rate) / total).alias("square"),
        (F.count("*") / total).alias("noise"),
    )
    spread = F.col("mean") * (1 - F.col("mean"))
    between = F.greatest(F.col("square") - F.col("mean") * F.col("mean") - spread * F.col("noise"), F.lit(1e-6))
    weight = F.least(F.greatest(spread / between - 1, F.lit(2.0)), F.lit(10_000.0))
    prior = sums.select(F.struct(F.col("mean"), weight.alias("weight")).alias("p")).scalar()
    shrunk = (F.col("n_failing") + prior["mean"] * prior["weight"]) / (F.col("n_docs") + prior["weight"])
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_ok", F.col("shrunk_rate") <= max_failing)


def judge(counted: DataFrame, max_failing: float = MAX_FAILING) -> DataFrame:
    """``counted`` with base_failed, host_ok (true without a host) and kept. Pass a written table: it is read twice."""
    verdicts = host_verdicts(counted, max_failing).select("_host", "host_ok")
    base = rules()["short"] | rules()["repeats"]
    return (
        counted.join(verdicts, "_host", "left")
        .withColumn("host_ok", F.coalesce("host_ok", F.lit(True)))
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
    )
