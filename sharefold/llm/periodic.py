"""Periodic runs of words: recursive splitting by word frequency, then a scan over the lags of what is left."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run has so many words at least, and so many times its period.
MIN_WORDS = 12
MIN_TIMES = 2

Segment = tuple[int, int]
Run = tuple[int, int, int]


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int32)


def _pieces(start: int, stop: int, cut: np.ndarray) -> list[Segment]:
    """What places ``cut`` (ascending, from ``start``) leave of a segment, where a run still has room."""
    edges = np.concatenate([[-1], cut, [stop - start]])
    long = np.flatnonzero(np.diff(edges) > MIN_WORDS)
    return [(start + int(edges[i]) + 1, start + int(edges[i + 1])) for i in long]


def frequent_segments(numbers: np.ndarray, start: int = 0, stop: int | None = None) -> list[Segment]:
    """Segments in which every word occurs often enough for a run that holds it.

    A run repeats its period, so each of its words is in it at least twice. A word that is rarer than that within a
    segment cannot be in a run there and splits it; the parts, in which other words may now be too rare, are split in
    turn until none changes.
    """
    done, todo = [], [(start, len(numbers) if stop is None else stop)]
    while todo:
        a, b = todo.pop()
        if b - a < MIN_WORDS:
            continue
        own = numbers[a:b]
        _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[inverse] < MIN_TIMES)
        if len(rare):
            todo += _pieces(a, b, rare)
        else:
            done.append((a, b))
    return sorted(done)


def _near_segments(numbers: np.ndarray, segment: Segment, low: int, high: int) -> list[Segment]:
    """The same splitting for periods from ``low`` up to ``high``: within a run of such a period each word has an
    equal one that many places before or behind. Words without one split; parts are split until none changes."""
    done, todo = [], [segment]
    while todo:
        a, b = todo.pop()
        if b - a < max(MIN_WORDS, MIN_TIMES * low):
            continue
        own = numbers[a:b]
        order = np.argsort(own, kind="stable")
        ranked = own[order].astype(np.int64) * (2 * (b - a) + 2) + order
        # The first equal word at least ``low`` places on: is it near enough?
        at = np.searchsorted(ranked, ranked + low)
        inside = at < len(ranked)
        ahead = np.zeros(len(ranked), bool)
        ahead[inside] = ranked[at[inside]] - ranked[inside] < high
        at = np.searchsorted(ranked, ranked - low, side="right") - 1
        inside = at >= 0
        behind = np.zeros(len(ranked), bool)
        behind[inside] = ranked[inside] - ranked[at[inside]] < high
        rare = np.sort(order[~(ahead | behind)])
        if len(rare):
            todo += _pieces(a, b, rare)
        else:
            done.append((a, b))
    return sorted(done)


def periodic_runs(numbers: np.ndarray) -> list[Run]:
    """All runs as (start, length, period), by start and then period.

    A run is a stretch with smallest period q, of MIN_WORDS words or more and at least MIN_TIMES q, that no neighbouring word extends.
    Segments that survive the splitting are scanned lag by lag, periods in doubling ranges; before each range a segment
    is split again by the words that cannot join a run of such a period. A stretch that lies within a run of a smaller
    period has none of a larger one (two periods p > q of a stretch of p + q words make a smaller one) and is left out.
    """
    runs: list[Run] = []
    for segment in frequent_segments(numbers):
        own: list[Run] = []
        left, low = [segment], 1
        while left and low * MIN_TIMES <= max(t - s for s, t in left):
            smaller = Cover(own)
            for s, t in [p for whole in left for p in _near_segments(numbers, whole, low, 2 * low)]:
                if not smaller.holds(s, t):
                    for lag in range(low, min(2 * low, (t - s) // MIN_TIMES + 1)):
                        own += _scan(numbers[s:t], s, lag, smaller)
            smaller = Cover(own)
            left = [p for p in left if not smaller.holds(*p)]
            low *= 2
        runs += own
    return sorted(runs, key=lambda r: (r[0], r[2]))


class Cover:
    """Tells whether a stretch lies within one of some runs."""

    def __init__(self, runs: list[Run]):
        ordered = sorted(runs)
        self.starts = [r[0] for r in ordered]
        self.stops = list(accumulate((r[0] + r[1] for r in ordered), max))

    def holds(self, start: int, stop: int) -> bool:
        before = bisect_right(self.starts, start)
        return before > 0 and self.stops[before - 1] >= stop


def _scan(own: np.ndarray, offset: int, lag: int, smaller: Cover) -> list[Run]:
    """Runs of the smallest period ``lag`` in a segment that starts at ``offset``. A stretch of this lag that has a smaller
    period, a divisor of it, lies within the run of that period, which an earlier range of periods has found."""
    differ = np.flatnonzero(own[lag:] != own[:-lag])
    edges = np.concatenate([[-1], differ, [len(own) - lag]])
    least = max(MIN_WORDS - lag, (MIN_TIMES - 1) * lag)
    found = []
    for i in np.flatnonzero(np.diff(edges) - 1 >= least):
        start, length = offset + int(edges[i]) + 1, int(edges[i + 1] - edges[i]) - 1 + lag
        if not smaller.holds(start, start + length):
            found.append((start, length, lag))
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


RUN_SCHEMA = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def periodic_column(text: str = "text") -> Column:
    """struct<runs, collapsed> of a text column: its runs by start and period, and its kept words joined by one space.

    Words are separated by space, tab, line feed, vertical tab, form feed and carriage return. A null or empty text has
    no runs and collapses to ''. Each text is read whole and on its own, so repeated rows and other columns play no part.
    """

    @F.arrow_udf(RUN_SCHEMA)
    def find(texts: pa.Array) -> pa.Array:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        rows = []
        for value in texts:
            words = (value.as_py() or "").encode().split()
            runs = periodic_runs(word_numbers(words))
            stay = kept_words(len(words), runs)
            kept = b" ".join(w for w, k in zip(words, stay, strict=True) if k).decode()
            rows.append({"runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], "collapsed": kept})
        return pa.array(rows, pa.struct([("runs", pa.list_(run)), ("collapsed", pa.string())]))

    return find(text)


def detect_runs(docs: DataFrame, text: str = "text", out: str = "_periodic") -> DataFrame:
    """``docs`` with ``periodic_column`` as ``out``, which must be a new name; rows and other columns stay."""
    if out in docs.columns:
        raise ValueError(f"the documents have a column {out} already")
    return docs.withColumn(out, periodic_column(text))
