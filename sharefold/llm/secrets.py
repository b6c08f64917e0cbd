"""Secret scans: patterns, and a character convolutional network over every candidate with its surroundings.

The network learns from all findings of the patterns and, against them, the other candidates of the same documents. Its
scores are calibrated on findings held back, and its threshold is the strictest one that keeps the wanted recall.
"""

from __future__ import annotations

import copy
import math
import re
from dataclasses import dataclass
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.convnet import ByteConvNet, windows_of
from sharefold.session import scratch_path
from sharefold.sinks import pin

KINDS = ("assign", "access", "hex", "token")

# The strict patterns; letters of the assigned names count in either case.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

# A window shows so many bytes before a candidate, a piece of it, and so many bytes after.
AROUND, PIECE = 20, 56
WINDOW = 2 * AROUND + PIECE

# The windows of all documents with findings are learnt, about so many in a task at a time and so often.
SHARD_WINDOWS, EPOCHS = 4000, 6
MIN_RECALL = 0.95

# Odds and parameters are added up in steps of one part in so many.
ODDS_STEPS, PARAMETER_STEPS = 1024, 1 << 24


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strict findings: leftmost, not overlapping within a kind. A match that fails
    its length is dropped, and the search goes on behind it."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Long runs of characters that secrets are made of."""
    return [m.span() for m in CANDIDATE.finditer(text)]


def overlap(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each span (in order, apart) meets a strict finding."""
    ends, hit, at = sorted((s, e) for s, _, e in base), [], 0
    reach = np.maximum.accumulate([e for _, e in ends]) if ends else []
    for start, end in spans:
        while at < len(ends) and reach[at] <= start:
            at += 1
        hit.append(any(start < e for _, e in takewhile(lambda x: x[0] < end, islice(ends, at, None))))
    return hit


def windows(text: str, start: int, end: int, bare: bool = False) -> list[bytes]:
    """The windows of a candidate: each piece of it with what stands around the whole; ``bare`` leaves that out."""
    before = b"" if bare else text[max(0, start - AROUND) : start].encode()[-AROUND:]
    after = b"" if bare else text[end : end + AROUND].encode()[:AROUND]
    body = text[start:end].encode()
    return [
        before.rjust(AROUND, b"\0") + body[i : i + PIECE].ljust(PIECE, b"\0") + after.ljust(AROUND, b"\0")
        for i in range(0, len(body), PIECE)
    ]


class SecretNet:
    """The network with its calibration (slope, offset of the log odds) and threshold."""

    def __init__(self, net: ByteConvNet, slope: float, offset: float, threshold: float):
        self.net, self.slope, self.offset, self.threshold = net, slope, offset, threshold
        self.quality: Quality | None = None

    def of_odds(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * odds + self.offset)))

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.of_odds(grid_odds(self.net, x) / ODDS_STEPS)

    def scores(self, text: str, spans: list[tuple[int, int]]) -> list[float]:
        """The calibrated probability of each candidate, that of its most suspicious piece."""
        parts = [windows(text, s, e) for s, e in spans]
        x, _ = windows_of([w for p in parts for w in p], WINDOW)
        p = self.calibrated(x)
        ends = np.cumsum([len(q) for q in parts])
        return np.maximum.reduceat(p, np.concatenate([[0], ends[:-1]])).tolist()


def candidate_windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """window, label (1 finding, 0 other candidate) and held (is its document one that the network does not learn from?) of
    the candidates in all documents that may have findings."""
    likely = F.col(text).rlike(r"(?i)password|passwd|secret|token|api_?key") | F.col(text).rlike("AKIA[A-Z0-9]{12}|[0-9a-f]{32}")

    def look(batches):
        for batch in batches:
            for value, held in zip(batch.column(0), batch.column(1), strict=True):
                body = value.as_py()
                base, spans = base_spans(body), candidates(body)
                rows = [(w, int(hit), held.as_py()) for (s, e), hit in zip(spans, overlap(spans, base), strict=True) for w in windows(body, s, e)]
                if rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.binary(), pa.int32(), pa.bool_()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["window", "label", "held"])

    held = F.pmod(F.xxhash64(F.lit("held"), text), F.lit(4)) == 0
    return docs.where(likely).select(text, held.alias("held")).mapInArrow(look, "window binary, label int, held boolean")


@dataclass(frozen=True)
class Quality:
    """What a fitted network does on windows of documents it has not learnt from."""

    recall: float
    precision: float
    findings: int
    others: int


def fit_secret_net(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shard_windows: int = SHARD_WINDOWS, min_recall: float = MIN_RECALL
) -> SecretNet | None:
    """Trains, calibrates and sets the threshold on all findings; None where a class has fewer than 20 windows to learn from.

    A quarter of the documents is held out: on their windows the odds are calibrated, the threshold is the strictest that keeps
    ``min_recall`` of their findings, in their own surroundings and in others, and ``quality`` says what it gives. A window
    that stands in documents of both parts is learnt from and not held. Windows are dealt to shards of about
    ``shard_windows``, of which a task holds one at a time; to the driver come the network's parameters and counts of odds.
    """
    spark = docs.sparkSession
    found = candidate_windows(docs, key, text).groupBy("window", "label").agg(F.min("held").alias("held"))
    # One scan serves both classes.
    found = pin(found, scratch_path(spark, "secret-windows"))
    known = {r.label: r for r in found.groupBy("label").agg(F.count("*").alias("n"), F.count_if("held").alias("held")).collect()}
    if min((known[y].n if y in known else 0) for y in (0, 1)) < 20:
        return None
    if any(known[y].held in (0, known[y].n) for y in (0, 1)):
        # Too few documents to hold whole ones out.
        found = found.withColumn("held", F.pmod(F.xxhash64(F.lit("apart"), "window"), F.lit(4)) == 0)
    shards = math.ceil((known[0].n + known[1].n) / shard_windows)
    dealt = found.withColumns({"shard": F.pmod(F.xxhash64(F.lit("shard"), "window"), F.lit(shards)), "order": F.xxhash64("window")})
    net = ByteConvNet(["other", "secret"], widths=(2, 3, 4), filters=8)
    # A single shard is learnt in one go. Several meet after every epoch.
    rounds, epochs = (1, EPOCHS) if shards == 1 else (EPOCHS, 1)
    for at in range(rounds):
        net = averaged(net, dealt.where(~F.col("held")), epochs, at)
    counts = odds_counts(net, dealt.where("held"))
    odds, truth, many = (np.array([r[i] for r in counts], float) for i in range(3))
    model = SecretNet(net, *platt(odds / ODDS_STEPS, truth, many=many), 1.0)
    sure = model.of_odds(odds / ODDS_STEPS)
    order = np.flatnonzero(truth == 1)[np.argsort(sure[truth == 1])]
    below = np.cumsum(many[order])
    model.threshold = float(sure[order][np.searchsorted(below, math.floor((1 - min_recall) * below[-1]), side="right")])
    taken = sure >= model.threshold
    hits, others = many[taken & (truth == 1)].sum(), many[taken & (truth == 0)].sum()
    model.quality = Quality(float(hits / below[-1]), float(hits / (hits + others)), int(below[-1]), int(many[truth == 0].sum()))
    return model


def seen_windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's windows and labels, and its findings in the surroundings of its other candidates with their labels."""
    table = table.sort_by([("label", "ascending"), ("order", "ascending"), ("window", "ascending")])
    rows = list(zip(table["window"].to_pylist(), table["label"].to_pylist(), strict=True))
    places = [w for w, y in rows if not y]
    mine = [w for w, y in rows if y] if places else []
    moved = [(p := places[k % len(places)])[:AROUND] + w[AROUND : AROUND + PIECE] + p[AROUND + PIECE :] for k, w in enumerate(mine)]
    own, elsewhere = (windows_of(ws, WINDOW)[0] if ws else np.empty((0, WINDOW), np.uint8) for ws in ([w for w, _ in rows], moved))
    return own, np.array([y for _, y in rows], int), elsewhere, np.ones(len(moved), int)


def averaged(net: ByteConvNet, dealt: DataFrame, epochs: int, at: int) -> ByteConvNet:
    """The network after ``epochs`` over all windows: each shard goes on from ``net`` by itself, and the mean of their
    parameters, weighted by windows, comes back. Each window is also seen without its surroundings, and each finding in those of
    another candidate, so that a secret is known by its own characters where nothing names it."""

    def learn(table: pa.Table) -> pa.Table:
        x, y, elsewhere, same = seen_windows(table)
        bare = x.copy()
        bare[:, :AROUND] = bare[:, AROUND + PIECE :] = 0
        least = 1000 if epochs > 1 else 0
        mine = copy.deepcopy(net).fit(np.concatenate([x, elsewhere, bare]), np.concatenate([y, same, y]), epochs=epochs, seed=2 + at, least_steps=least)
        flat = np.concatenate([mine.p[k].ravel() for k in sorted(mine.p)]).astype(float)
        n = len(x)
        # Whole numbers add up to the same sum in any order.
        return pa.table({"place": np.arange(len(flat)), "total": np.round(flat * PARAMETER_STEPS).astype(np.int64) * n, "n": np.full(len(flat), n)})

    parts = dealt.groupBy("shard").applyInArrow(learn, "place bigint, total bigint, n bigint")
    means = parts.groupBy("place").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("place").collect()
    flat, out = np.array([r["mean"] for r in means]) / PARAMETER_STEPS, copy.deepcopy(net)
    for k in sorted(out.p):
        out.p[k], flat = flat[: out.p[k].size].reshape(out.p[k].shape).astype(np.float32), flat[out.p[k].size :]
    return out


def odds_counts(net: ByteConvNet, held: DataFrame) -> list:
    """(odds, label, how many) of all held windows and of held findings in other surroundings; odds as ``grid_odds``, of which
    there are a bounded number."""

    def count(table: pa.Table) -> pa.Table:
        x, y, elsewhere, same = seen_windows(table)
        both = np.stack([grid_odds(net, np.concatenate([x, elsewhere])), np.concatenate([y, same])], axis=1)
        rows, many = np.unique(both, axis=0, return_counts=True)
        return pa.table({"odds": rows[:, 0], "label": rows[:, 1], "many": many})

    parts = held.groupBy("shard").applyInArrow(count, "odds bigint, label bigint, many bigint")
    return parts.groupBy("odds", "label").agg(F.sum("many").alias("many")).orderBy("odds", "label").collect()


def grid_odds(net: ByteConvNet, x: np.ndarray) -> np.ndarray:
    """Log odds of a secret in steps of 1 / ODDS_STEPS, as whole numbers."""
    p = np.clip(net.probabilities(x)[:, 1].astype(np.float64), 1e-7, 1 - 1e-7)
    return np.floor(np.log(p / (1 - p)) * ODDS_STEPS).astype(np.int64)


def platt(odds: np.ndarray, truth: np.ndarray, rounds: int = 100, many: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that turn log odds into calibrated ones, by Newton's steps; targets are smoothed so that neither
    runs away, and a small pull to slope 1 and offset 0 settles what the data leaves open. Each of ``odds`` stands for
    ``many`` equal ones."""
    many = np.ones(len(odds)) if many is None else many
    yes, no = many[truth == 1].sum(), many[truth == 0].sum()
    target = np.where(truth == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    scaled = np.stack([odds, np.ones_like(odds)], axis=1)
    rest, pull = np.array([1.0, 0.0]), 1e-3

    def loss(at: np.ndarray) -> float:
        z = scaled @ at
        return float((many * (np.logaddexp(0, z) - target * z)).sum() + pull / 2 * ((at - rest) ** 2).sum())

    at = rest
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(scaled @ at, -500, 500)))
        slope = scaled.T @ (many * (p - target)) + pull * (at - rest)
        step = np.linalg.solve((scaled * (many * p * (1 - p))[:, None]).T @ scaled + pull * np.eye(2), slope)
        # Halved until it helps, since a full step can overshoot where all odds are far out.
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        if size <= 1e-6 or np.abs(size * step).max() < 1e-9:
            break
        at = at - size * step
    return float(at[0]), float(at[1])


def secrets_column(model: SecretNet | None, text: str = "text") -> Column:
    """array<struct<start, kind_no, stop, score>> of a text column, ordered by start and kind.

    Places are code points, the end exclusive. Strict findings have score 1. A further candidate is added as ``token``
    when it meets no strict finding and its probability reaches the model's threshold.
    A null text has none; without a model nothing is added.
    """

    @F.arrow_udf("array<struct<start:bigint,kind_no:int,stop:bigint,score:double>>")
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            body = value.as_py() or ""
            base = base_spans(body)
            rows = [(s, k + 1, e, 1.0) for s, k, e in base]
            if model is not None:
                spans = candidates(body)
                spans = [c for c, hit in zip(spans, overlap(spans, base), strict=True) if not hit]
                for at in range(0, len(spans), 1024):
                    part = spans[at : at + 1024]
                    for (s, e), p in zip(part, model.scores(body, part), strict=True):
                        if p >= model.threshold:
                            rows.append((s, len(KINDS), e, p))
            names = ("start", "kind_no", "stop", "score")
            out.append([dict(zip(names, r, strict=True)) for r in sorted(rows)])
        kind = pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("stop", pa.int64()), ("score", pa.float64())])
        return pa.array(out, pa.list_(kind))

    return scan(F.col(text))
