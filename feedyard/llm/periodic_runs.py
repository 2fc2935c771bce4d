"""Periodic runs of words: minimizers of several scales propose periods, direct scans cover the short ones, every run is extended word by word."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.llm.common import chunks, id_text

MIN_LENGTH = 24
POWER = 3  # periods that a run holds at least; the scales below are worked out for three
SHORT = 8  # periods up to this one are found by comparing the text with itself at that lag
PIECE = 1 << 20
BLOCK = 32

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Vocabulary(dict):
    """Numbers words by first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _pieces(body: bytes) -> Iterator[bytes]:
    """A text in pieces of about PIECE bytes that end between words, so that a long one is never a list of all its words."""
    at = 0
    while at < len(body):
        end = at + PIECE
        while end < len(body) and body[end] not in b"\t\n\x0b\x0c\r ":
            end += 1
        yield body[at:end]
        at = end


def word_ids(body: bytes, vocabulary: Vocabulary) -> np.ndarray:
    parts = [np.fromiter(map(vocabulary.__getitem__, piece.split()), np.int64) for piece in _pieces(body)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of hashes."""
    x = (a ^ (a >> np.uint64(31))) * _A + b
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _ahead(a: np.ndarray, by: int) -> np.ndarray:
    """``a`` moved to the left, with zeros behind it."""
    return np.concatenate([a[by:], np.zeros(min(by, len(a)), a.dtype)])


def _windows(a: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """``of`` (minimum or maximum) over all windows of ``size`` values, by doubling."""
    span = 1
    while 2 * span <= size:
        a, span = of(a[:len(a) - span], a[span:]), 2 * span
    return of(a[:len(a) - (size - span)], a[size - span:]) if size > span else a


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """``(low, w, v)``: at this scale minima of the hashes of w words, over windows of v neighbours, find periods from low + 1 to w.

    A run of period q, low < q <= w, holds at least 3 q - w + 1 stretches of w words. Two of them are equal just when their
    distance is a multiple of q, since w >= q. Windows of v of them, v = 2 (low + 1) - w + 1 <= 2 q - w + 1, fit in twice at distance q,
    so a minimum of the one comes back at distance q in the other and nothing equal lies between.
    """
    low = SHORT
    while POWER * (low + 1) <= longest:
        w = low * 3 // 2
        yield low, w, (POWER - 1) * (low + 1) - w + 1
        low = w


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _extend(x: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The widest range around ``at`` in which every word equals the one ``lag`` later; empty if that at ``at`` does not."""
    end, step = at, BLOCK
    while end + lag < len(x):
        there = x[end + lag:end + lag + step]
        differ = np.flatnonzero(x[end:end + len(there)] != there)
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + len(there), 2 * step
    start, step = at, BLOCK
    while start > 0 and end > at:
        begin = max(0, start - step)
        differ = np.flatnonzero(x[begin:start] != x[begin + lag:start + lag])
        if len(differ):
            start = begin + int(differ[-1]) + 1
            break
        start, step = begin, 2 * step
    return start, end


def _seeds(h: np.ndarray, v: int, low: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """``(lag, position)`` of minimizers whose next equal one is ``lag`` further, low < lag <= w; one per chain of overlapping ones."""
    if len(h) < v:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(v - 1, h.dtype)
    lowest = np.concatenate([edge, _windows(h, v, np.minimum), edge])
    chosen = np.flatnonzero(h == _windows(lowest, v, np.maximum))
    order = chosen[np.argsort(h[chosen], kind="stable")]
    lag = np.diff(order)
    pair = (h[order[1:]] == h[order[:-1]]) & (lag > low) & (lag <= w)
    lag, at = lag[pair], order[:-1][pair]
    by = np.lexsort((at, lag))
    lag, at = lag[by], at[by]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + w)
    return lag[fresh], at[fresh]


def find_runs(docs: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each document of word numbers, by start and period.

    A run is a stretch of at least ``min_length`` words and three periods whose words equal those one period later, period being the
    smallest such, and that cannot be extended. Documents are laid behind one another with separators that
    occur once, so no run crosses them; those too short for a scale are left out of it and of all wider ones.
    """
    sizes = np.array([len(d) for d in docs], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    x = np.empty(int((sizes + 1).sum()), np.int64)
    for begin, d in zip(begins, docs):
        x[begin:begin + len(d)] = d
    x[begins + sizes] = -1 - np.arange(len(docs))
    found: dict[tuple[int, int], int] = {}

    def keep(start: int, length: int, period: int) -> None:
        if length >= max(min_length, POWER * period):
            found[start, length] = min(period, found.get((start, length), period))

    for lag in range(1, SHORT + 1):
        for start, end in zip(*_stretches(x[lag:] == x[:-lag], max(min_length, POWER * lag) - lag)):
            keep(int(start), int(end - start) + lag, lag)
    place, left = np.arange(len(x)), sizes + 1
    x, h, span = x.copy(), _mix(x.astype(np.uint64), np.zeros(len(x), np.uint64)), 1
    for low, w, v in scales(int(sizes.max(initial=0))):
        stay = left > POWER * (low + 1)
        if not stay.all():
            part = np.repeat(stay, left)
            x, h, place, left = x[part], h[part], place[part], left[stay]
        while 2 * span <= w:
            h, span = _mix(h, _ahead(h, span)), 2 * span
        for lag, at in zip(*map(np.ndarray.tolist, _seeds(_mix(h, _ahead(h, w - span)), v, low, w))):
            start, end = _extend(x, at, lag)
            keep(int(place[start]), end - start + lag, lag)
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    of = np.searchsorted(begins, [s for s, _ in found], side="right") - 1
    for d, ((start, length), period) in zip(of.tolist(), found.items()):
        out[d].append((start - int(begins[d]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length per period; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: all but those that some run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(min_length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in chunks(batches):
            vocabulary = Vocabulary()
            docs = [word_ids(body, vocabulary) for body in bodies]
            words = list(vocabulary)
            rows = find_runs(docs, min_length)
            texts = [b" ".join(map(words.__getitem__, (d[collapsed(len(d), r)] if r else d).tolist())).decode() for d, r in zip(docs, rows)]
            best = [strongest(r) for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(map(len, docs), pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in doc] for doc in rows], RUNS),
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], RUNS.value_type),
                pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "strongest", "collapsed_text"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``(doc_id, n_words, runs, strongest, collapsed_text)`` of every row; a run is ``(start, length, period)`` in words.

    In ``collapsed_text`` each run is cut to its first period, words joined by one space. A text without runs keeps all its words. NULL and empty
    texts have no words and no runs, and an empty collapsed text; NULL and repeated ids and repeated rows are rows like
    any other. One text is one task's work at a time, about 2 MiB of text or one longer text.
    """
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return id_text(docs, id_col, text_col).mapInArrow(_scan(min_length), f"doc_id bigint, n_words bigint, runs array<{run}>, strongest {run}, collapsed_text string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which a tenth of the documents, by crc32 of the id, repeats some of its words to the end; others keep their text.

    With h the crc32 and g = h div 10, in documents of n > 0 words with h mod 10 = 0 word i >= a becomes word a + (i - a) mod p, where
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    code = F.crc32(F.col(id_col).cast("string").cast("binary"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.when(code % 10 == 0, words).alias("words"), F.floor(code / 10).alias("g"))
    n = F.size("words")
    start = (F.col("g") % n).cast("int")
    cycle = (1 + F.floor((n - F.col("start")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.withColumn("start", F.when(n > 0, start)).withColumn("cycle", cycle)

    def word(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("start"), i).otherwise(F.col("start") + (i - F.col("start")) % F.col("cycle")))

    planted = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("start").isNotNull(), planted).otherwise(F.col("text")).alias(text_col))
