"""Mixing sources to target weights along a curriculum: weight schedules are integrated, cumulative demand is inverted to training positions."""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.llm.common import running_sum, source_key, written

# A schedule is a line through (time, weight) knots, time from 0 to 1; its integral is the weight of the source in the whole mix.
Schedule = Sequence[tuple[float, float]]
# By order of source, repeating: a falling one of weight 3, a rising one of weight 1, one of weight 2 with its peak in the middle.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 4.5), (1.0, 1.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)))
SHARE = 1.5
REPEATS = 2.0
SEED = "curriculum"

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False


def word_count(body: bytes) -> int:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    solid = _SOLID[np.frombuffer(body, np.uint8)]
    return int(np.count_nonzero(solid[1:] > solid[:-1])) + int(solid[:1].sum())


def _sized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.array([word_count(body.as_py()) for body in batch.column("body")], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], [*batch.schema.names[:-1], "size"])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, nameless, name, crc, size)``: size is the number of words, NULL text has none."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *source_key(source_col), F.crc32(body).alias("crc"), body.alias("body"))
    return rows.mapInArrow(_sized, "doc_id bigint, nameless boolean, name string, crc bigint, size bigint")


def area(schedule: Schedule) -> float:
    """The integral of a schedule over time."""
    return math.fsum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def time_of(schedule: Schedule, demand: Column) -> Column:
    """The time at which the integral of a schedule reaches ``demand``, between 0 and its area."""
    pieces, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        step = (t1 - t0) * (w0 + w1) / 2
        slope, over = (w1 - w0) / (t1 - t0), demand - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * over))
        here = F.when(over <= 0, F.lit(t0)).otherwise(F.least(F.lit(t1), F.lit(t0) + F.lit(2.0) * over / (F.lit(w0) + root)))
        pieces.append((done + step, here))
        done += step
    out = pieces[-1][1]
    for end, here in reversed(pieces[:-1]):
        out = F.when(demand <= F.lit(end), here).otherwise(out)
    return out


def _by_turn(number: Column, values: Sequence[Column]) -> Column:
    """``values[number mod their count]``; only that one is evaluated."""
    return reduce(lambda rest, k: F.when(number % len(values) == k, values[k]).otherwise(rest), range(len(values) - 1), values[-1])


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """``(nameless, name, source_no, source_size, target)`` of the sources of ``sizes`` (nameless, name, size).

    Sources are numbered by code point, the nameless one last, and take the schedules in turn. The targets are the mix's
    ``share`` of all words by weight, none above ``repeats`` times its source: filled to one level, in the order in which
    sources reach their limit, by running sums; only totals reach the driver, however many sources there are.
    """
    sources = written(sizes.groupBy("nameless", "name").agg(F.sum("size").alias("source_size")).withColumn("all", F.lit(0).cast("bigint")), "sources")
    numbered = running_sum(sources, "all", [F.col("nameless"), F.col("name")], {}).withColumnRenamed("place", "source_no")
    weight = _by_turn(F.col("source_no"), [F.lit(area(s)) for s in schedules])
    limited = numbered.withColumn("weight", weight).withColumn("limit", F.lit(repeats) * F.col("source_size"))
    filled = running_sum(limited, "all", [F.col("limit") / F.col("weight"), F.col("source_no")], {"limit": "full", "weight": "gone"})
    words, weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, weights = share * (words or 0), weights or 0.0
    level = (F.lit(wanted) - F.col("full")) / F.nullif(F.lit(weights) - F.col("gone"), F.lit(0.0))
    filled = written(filled.select("nameless", "name", "source_no", "source_size", "weight", "limit", (F.col("limit") / F.col("weight") <= level).alias("limited")), "levels")
    full, gone = filled.filter("limited").agg(F.coalesce(F.sum("limit"), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    rest = (wanted - full) / (weights - gone) if weights > gone else 0.0
    return filled.select("nameless", "name", "source_no", "source_size", F.when(F.col("limited"), F.col("limit")).otherwise(F.col("weight") * F.lit(rest)).alias("target"))


def training_order(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, repeats: float = REPEATS, seed: str = SEED,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix in training order, one row per visit of a document: ``(source_no, place, doc_id, size, source_size, target, visit, words, position, start)``.

    Within its source every document has a ``place``, drawn by a digest of its id; the source's documents are laid end to end in that
    order, again and again, until its target is reached. The last document is cut there, so each source gives exactly
    ``floor(target)`` words. A visit's ``position`` is the time, 0 to 1, at which the integral of the source's schedule,
    scaled to the target, reaches the middle of the visit; so at any time sources are met in proportion to their scheduled
    weights. Rows are range-sorted by position; ``start`` counts the words of the mix before the visit.

    A document that is never visited has one row of no words, without visit and position, at the end. NULL text has no words; a NULL source is
    the last one; NULL and repeated ids and repeated rows are rows like any other, told apart by ``(source_no, place)``.
    """
    sizes = written(sized(docs, id_col, text_col, source_col), "sizes")
    targets = written(source_targets(sizes, schedules, share, repeats), "targets")
    drawn = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("|" + seed)).cast("binary")))
    rows = sizes.join(targets, ["nameless", "name"]).select("source_no", "doc_id", "size", "crc", "source_size", "target", drawn.alias("drawn"))
    laid = running_sum(rows, "source_no", [F.col("drawn"), F.col("doc_id"), F.col("size"), F.col("crc")], {"size": "before"}).drop("drawn", "crc")
    def visit(k: int) -> Column:
        begin = F.col("source_size") * k + F.col("before")
        return F.struct(F.lit(k).alias("visit"), begin.alias("from"), F.least(F.col("size"), F.floor("target") - begin).alias("words"))

    visits = F.filter(F.array(*map(visit, range(math.ceil(repeats)))), lambda v: v["words"] > 0)
    met = laid.select(*[c for c in laid.columns if c != "before"], F.explode_outer(visits).alias("v"))
    met = met.select("*", "v.visit", "v.from", F.coalesce("v.words", F.lit(0).cast("bigint")).alias("words")).drop("v")
    middle = F.col("from") + F.col("words") / F.lit(2.0)
    position = _by_turn(F.col("source_no"), [time_of(s, middle * F.lit(area(s)) / F.col("target")) for s in schedules])
    met = met.withColumn("position", F.when(F.col("visit").isNotNull(), position))
    met = met.drop("from").withColumn("all", F.lit(0).cast("bigint")).withColumnRenamed("place", "at")
    out = running_sum(met, "all", [F.col("position").asc_nulls_last(), F.col("source_no"), F.col("at"), F.col("visit")], {"words": "start"})
    return out.select("source_no", F.col("at").alias("place"), "doc_id", "size", "source_size", "target", "visit", "words", "position", "start")


def mix(docs: DataFrame, **options) -> DataFrame:
    """What the training order takes of each document: ``(doc_id, size, source_size, target, taken, visits, first_position, first_start)``.

    One row per row of ``docs``; the last two are NULL where nothing is taken. Options are those of ``training_order``.
    """
    order = training_order(docs, **options)
    taken = order.groupBy("source_no", "place").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("words").alias("taken"), F.count("visit").alias("visits"),
        F.min("position").alias("first_position"), F.min(F.when(F.col("visit").isNotNull(), F.col("start"))).alias("first_start"))
    return taken.drop("source_no", "place")
