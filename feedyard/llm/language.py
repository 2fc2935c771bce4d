"""Language identification: interpolated Kneser-Ney character models, in sorted hash arrays or, when large, as tables."""
from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.operators.skew import lookup_join
from feedyard.session import stable, work_dir

ORDER = 4
BITS = 64
# Models of at most so many cells (n-grams and contexts x languages) are collected and broadcast, larger ones are joined.
BROADCAST_CELLS = 1 << 22
EDGE = "\x02"  # stands before a word, ORDER - 1 times, and once after it
WORDS_KEPT = 500_000
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
# A text is rejected when its cross-entropy exceeds what this share of the training texts of its language stays below.
ACCEPTED = 0.995

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; the class of ``re`` also takes numerals beyond decimal digits, which are cut out."""
    words = _LETTERS.findall(text.lower())
    if not text.isascii() and not all(map(str.isalpha, words)):
        words = [x for w in words if (x := "".join(filter(str.isalpha, w)))]
    return words


# Odd multipliers per order, kind (n-gram or context) and place.
_STEPS = np.random.default_rng(13).integers(1, 1 << 63, (ORDER + 1, 2, ORDER), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGE_POINT = ord(EDGE)


def _points(texts: Iterable[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)


def _slots(points: np.ndarray, begins: np.ndarray, order: int, context: int, bits: int) -> np.ndarray:
    """Slot of the n-gram of ``order`` characters at each begin, or of its context, which lacks the last character."""
    total = np.full(len(begins), order, np.uint64)
    for j in range(order - context):
        total += points[begins + j] * _STEPS[order, context, j]
    total = (total ^ (total >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    total = (total ^ (total >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (total ^ (total >> np.uint64(31))) >> np.uint64(64 - bits)


class KneserNey:
    """One model per language over shared sorted arrays of n-gram hashes.

    ``order k``: hashes of n-grams of k characters, and per language the discounted share of each in its context; and
    hashes of contexts of k - 1 characters with the weight that passes to order k - 1. Order ``ORDER`` uses counts, lower
    orders the number of distinct characters before the n-gram. Order 1 is mixed with a uniform floor.
    """

    def __init__(self, languages: list[str], bits: int, orders: dict[int, tuple], floor: float) -> None:
        self.languages, self.bits, self.orders, self.floor = languages, bits, orders, floor
        self.name = uuid.uuid4().hex

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Sum of log2 p over each word's characters and its end; one row per word, one column per language."""
        if not words or not self.languages:
            return np.zeros((len(words), len(self.languages)))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        edge = EDGE * (ORDER - 1)
        points = _points([edge + w + EDGE for w in words])
        ends = np.cumsum(sizes)
        # where each predicted character stands: words are padded in front
        last = np.arange(ends[-1]) + np.repeat(np.arange(1, len(words) + 1) * (ORDER - 1), sizes)
        p = np.full((len(last), len(self.languages)), self.floor)
        for k in range(1, ORDER + 1):
            hashes, share, context_hashes, weight = self.orders[k]
            own = _find(hashes, _slots(points, last - k + 1, k, 0, self.bits))
            ctx = _find(context_hashes, _slots(points, last - k + 1, k, 1, self.bits))
            # what is not found takes the row behind the last: no share, all weight to the lower order
            p = share[own] + weight[ctx] * p
        return np.add.reduceat(np.log2(p), ends - sizes, axis=0)


def _find(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted table, -1 where it is not."""
    if not len(table):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of a task; written out whenever many distinct words are held."""
    held: dict[str, Counter] = {}

    def out():
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), pa.array(counts.keys()), pa.array(counts.values(), pa.int64())], ["lang", "word", "n"])
        held.clear()

    for batch in batches:
        for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update(words_of(body.decode()))
        if sum(map(len, held.values())) > WORDS_KEPT:
            yield from out()
    yield from out()


def _grams(word: Column) -> Column:
    """The n-grams of ``ORDER`` that predict each character of a word and its end."""
    padded = F.concat(F.lit(EDGE * (ORDER - 1)), word, F.lit(EDGE))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substr(padded, i, F.lit(ORDER)))


def gather_counts(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(k, lang, gram, n)`` over all training rows: counts of n-grams of ``ORDER``, below that numbers of distinct left characters."""
    rows = training.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("body")).filter("lang is not null and body is not null")
    words = rows.mapInArrow(_word_counts, "lang string, word string, n bigint")
    # counted by words of the task first; a frequent word reaches the shuffle once per task
    grams = words.select("lang", "n", F.explode(_grams(F.col("word"))).alias("gram"))
    level = stable(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    out = level.select(F.lit(ORDER).alias("k"), "lang", "gram", "n")
    for k in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.substr(F.col("gram"), F.lit(2)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        out = out.union(level.select(F.lit(k).alias("k"), "lang", "gram", "n"))
    return out


class Shares(NamedTuple):
    """The models as tables: ``grams`` (k, lang, gram, share), ``contexts`` (k, lang, context, weight); ``lang`` is a place in ``languages``.

    ``cells``: what dense arrays of all n-grams and contexts by language have at most.
    """

    languages: list[str]
    grams: DataFrame
    contexts: DataFrame
    floor: float
    cells: int


def shares(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Shares:
    """Models from all ``training`` rows with text and language, worked out in Spark from whole n-grams per language."""
    counts = stable(gather_counts(training, text_col, lang_col))
    single = counts.filter("k = 1")
    languages = sorted(r["lang"] for r in single.select("lang").distinct().collect())
    names = F.array(*map(F.lit, languages)) if languages else F.expr("cast(array() as array<string>)")
    counts = counts.select("k", (F.array_position(names, F.col("lang")) - 1).cast("int").alias("lang"), "gram", F.expr("substring(gram, 1, k - 1)").alias("context"), "n")
    once, twice = (F.count(F.when(F.col("n") == c, 1)) for c in (1, 2))
    discount = F.least(F.greatest(F.when(once + twice > 0, once / (once + 2 * twice)).otherwise(0.5), F.lit(0.1)), F.lit(0.9))
    discounts = counts.groupBy("k", "lang").agg(discount.alias("discount"))  # a row per order and language
    contexts = counts.groupBy("k", "lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).join(F.broadcast(discounts), ["k", "lang"])
    contexts = stable(contexts.withColumn("weight", F.col("discount") * F.col("kinds") / F.col("total")))
    grams = stable(counts.join(contexts, ["k", "lang", "context"]).select("k", "lang", "gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("share")))
    alphabet = max(2, single.select("gram").distinct().count())
    cells = (grams.count() + contexts.count()) * len(languages)
    return Shares(languages, grams, contexts.select("k", "lang", "context", "weight"), 1.0 / alphabet, cells)


def in_memory(tables: Shares) -> KneserNey:
    """The models as arrays under 64-bit hashes, for tables that are known to be small."""

    def collected(rows: DataFrame, kind: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ks, points = batch.column(0).to_numpy(), _points(batch.column(2).to_pylist())
                begins, own = np.cumsum(ks - kind) - (ks - kind), np.zeros(len(ks), np.uint64)
                for k in range(1, ORDER + 1):
                    own[ks == k] = _slots(points, begins[ks == k], k, kind, BITS)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.view(np.int64)), batch.column(3)], ["k", "lang", "hash", "value"])

        table = rows.mapInArrow(hashed, "k int, lang int, hash bigint, value double").toArrow()
        k, lang, own, value = (table[c].to_numpy() for c in ("k", "lang", "hash", "value"))
        out = {}
        for order in range(1, ORDER + 1):
            here = k == order
            hashes, at = np.unique(own[here].view(np.uint64), return_inverse=True)
            # the row behind the last is for what is not found; languages that lack an n-gram or a context have the same there
            dense = np.full((len(hashes) + 1, len(tables.languages)), float(kind), np.float32)
            dense[at, lang[here]] = value[here]
            out[order] = hashes, dense
        return out

    own, contexts = collected(tables.grams, 0), collected(tables.contexts, 1)
    return KneserNey(tables.languages, BITS, {k: (*own[k], *contexts[k]) for k in own}, tables.floor)


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> KneserNey:
    """Models in memory from all ``training`` rows with text and language."""
    return in_memory(shares(training, text_col, lang_col))


_WORDS: dict[str, dict[str, bytes]] = {}


def _remembered(model: str) -> dict[str, bytes]:
    """Scores of words under a model, kept over the tasks of a Python worker; those of other models are forgotten."""
    if model not in _WORDS:
        _WORDS.clear()
        _WORDS[model] = {}
    return _WORDS[model]


def _working(docs: DataFrame, id_col: str, text_col: str, passed: tuple[Column, ...]) -> DataFrame:
    extra = [c.alias(f"x{i}") for i, c in enumerate(passed)]
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"), *extra)


def cross_entropies(docs: DataFrame, model: KneserNey, id_col: str, text_col: str, *passed: Column) -> DataFrame:
    """``(id, n_letters, ce array<double>, ...)``: bits per character of whole texts under each language."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)  # bounded by BROADCAST_CELLS
    rows = _working(docs, id_col, text_col, passed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kinds, known = len(m.languages), _remembered(m.name)
        for batch in batches:
            sizes, ces = [], []
            bodies = batch.column(1)
            for a in range(0, len(bodies), 500):
                texts = [words_of(b.decode()) for b in bodies[a:a + 500].to_pylist()]
                if len(known) > WORDS_KEPT:
                    known.clear()
                new = list(set().union(*texts).difference(known))
                if new:
                    for word, row in zip(new, m.log_probabilities(new)):
                        known[word] = row.tobytes()
                for words in texts:
                    sizes.append(sum(map(len, words)))
                    total = np.frombuffer(b"".join(map(known.__getitem__, words))).reshape(len(words), kinds).sum(0)
                    ces.append((-total / max(1, sizes[-1] + len(words))).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ces, pa.list_(pa.float64())),
                                              *[batch.column(k) for k in range(2, batch.num_columns)]],
                                             ["id", "n_letters", "ce", *[f"x{i}" for i in range(batch.num_columns - 2)]])

    kinds = "".join(f", x{i} {t}" for i, (_, t) in enumerate(rows.dtypes[2:]))
    return rows.mapInArrow(run, f"id bigint, n_letters bigint, ce array<double>{kinds}")


def _word_logs(words: DataFrame, tables: Shares) -> DataFrame:
    """``words`` (word, rows) with ``logs``: sum of log2 p over each word's characters and its end, by language."""
    places = range(len(tables.languages))

    def dense(rows: DataFrame, key: str, value: str) -> DataFrame:
        return rows.groupBy(key).agg(F.array(*[F.max(F.when(F.col("lang") == i, F.col(value))) for i in places]).alias(value))

    grams = stable(words.select("word", F.explode(_grams(F.col("word"))).alias("gram")).groupBy("word", "gram").agg(F.count(F.lit(1)).alias("times")))
    needed = {ORDER: stable(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")))}
    for k in range(ORDER - 1, 0, -1):
        needed[k] = needed[k + 1].select(F.expr("substring(gram, 2)").alias("gram")).distinct()
    below = None
    for k in range(1, ORDER + 1):  # every join key has at most as many rows as there are characters
        here = needed[k].withColumns({"context": F.substr("gram", F.lit(1), F.lit(k - 1)), "shorter": F.expr("substring(gram, 2)")})
        here = here.join(dense(tables.grams.filter(F.col("k") == k), "gram", "share"), "gram", "left")
        here = here.join(dense(tables.contexts.filter(F.col("k") == k), "context", "weight"), "context", "left")
        here = here.withColumn("below", F.array(*[F.lit(tables.floor)] * len(places))) if below is None else here.join(
            below.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
        p = [F.coalesce(F.get("share", F.lit(i)), F.lit(0.0)) + F.coalesce(F.get("weight", F.lit(i)), F.lit(1.0)) * F.get("below", F.lit(i)) for i in places]
        below = stable(here.select("gram", F.array(*p).alias("p"), *["rows"] * (k == ORDER)))
    scored = lookup_join(grams, below, ["gram"], "rows").groupBy("word").agg(
        F.array(*[F.sum(F.col("times") * F.log2(F.get("p", F.lit(i)))) for i in places]).alias("logs"))
    return stable(words.join(scored, "word"))


def cross_entropies_by_join(docs: DataFrame, tables: Shares, id_col: str, text_col: str, *passed: Column) -> DataFrame:
    """As ``cross_entropies``, for models of any size: distinct words are scored by joins and joined to the texts that hold them."""
    rows = _working(docs, id_col, text_col, passed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [words_of(b.decode()) for b in part.column(1).to_pylist()]
                counts = [Counter(words) for words in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(texts)), pa.int64()), part.column(0), pa.array([sum(map(len, w)) for w in texts], pa.int64()), pa.array(map(len, texts), pa.int64()),
                     pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())), *[part.column(k) for k in range(2, part.num_columns)]],
                    ["row", "id", "n_letters", "n_words", "words", "times", *[f"x{i}" for i in range(part.num_columns - 2)]])
                row += len(texts)

    extra = rows.dtypes[2:]
    held = stable(rows.mapInArrow(run, "row bigint, id bigint, n_letters bigint, n_words bigint, words array<string>, times array<bigint>" + "".join(f", {c} {t}" for c, t in extra)))
    facts = held.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    words = stable(facts.groupBy("word").agg(F.count(F.lit(1)).alias("rows")))
    places = range(len(tables.languages))
    totals = lookup_join(facts, _word_logs(words, tables), ["word"], "rows").groupBy("row").agg(
        F.array(*[F.sum(F.col("times") * F.get("logs", F.lit(i))) for i in places]).alias("totals"))
    ce = [-F.coalesce(F.get("totals", F.lit(i)), F.lit(0.0)) / F.greatest(F.lit(1), F.col("n_letters") + F.col("n_words")) for i in places]
    return held.join(totals, "row", "left").select("id", "n_letters", F.array(*ce).alias("ce"), *[c for c, _ in extra])


def identify(docs: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` of every row.

    Models, temperature and rejection limits are learned from all rows of ``docs`` where ``in_training`` holds and text and
    language are not NULL. The prediction has the lowest cross-entropy per character; ties go to the first by name.
    ``score`` is its share in the softmax of the negative cross-entropies, at the temperature that fits all training rows
    best. ``rejected`` marks texts whose cross-entropy is above nearly all training texts of the predicted language.
    NULL texts and texts without letters, and any text if nothing could be learned, are ``und`` with score 0 and rejected.
    Repeated and NULL ids are rows like any other. Models of more than ``broadcast_cells`` cells stay tables and are joined.
    """
    spark = docs.sparkSession
    tables = shares(docs.filter(in_training), text_col, lang_col)
    names = F.array(*map(F.lit, tables.languages)) if tables.languages else F.expr("cast(array() as array<string>)")
    score, model = (cross_entropies, in_memory(tables)) if tables.cells <= broadcast_cells else (cross_entropies_by_join, tables)
    rows = score(docs, model, id_col, text_col, F.coalesce(in_training, F.lit(False)), F.col(lang_col).cast("string"))
    best = F.array_min("ce")
    rows = rows.withColumns({"best": best, "at": F.array_position("ce", best)})
    rows.select("id", "n_letters", "ce", "best", "x0", "x1", F.when((F.col("n_letters") > 0) & (F.size("ce") > 0), F.try_element_at(names, F.col("at").cast("int"))).alias("pred")
                ).write.parquet(folder := work_dir(spark, "languages"))
    rows = spark.read.parquet(folder)
    known = rows.filter("x0 and pred is not null and x1 is not null")

    def share(position: Column, temperature: float) -> Column:
        return 1 / F.aggregate("ce", F.lit(0.0), lambda acc, x: acc + F.exp(-temperature * (x - F.try_element_at("ce", position.cast("int")))))

    own = F.array_position(names, F.col("x1"))
    loss = known.filter(own > 0).agg(*[F.avg(-F.log(F.greatest(share(own, t), F.lit(1e-12)))).alias(str(i)) for i, t in enumerate(TEMPERATURES)]).first()
    temperature = min(zip((v if v is not None else 0.0 for v in loss), TEMPERATURES))[1]
    limits = known.filter("pred = x1").groupBy("pred").agg(F.percentile_approx("best", ACCEPTED, 10000).alias("limit"))  # one row per language
    judged = rows.join(F.broadcast(limits), "pred", "left")
    return judged.select(F.col("id").alias("doc_id"), F.coalesce("pred", F.lit("und")).alias("lang_pred"),
                         F.when(F.col("pred").isNotNull(), F.least(share(F.array_position("ce", F.col("best")), temperature), F.lit(1.0))).otherwise(0.0).alias("score"),
                         (F.col("pred").isNull() | F.coalesce(F.col("best") > F.col("limit"), F.lit(False))).alias("rejected"),
                         F.coalesce("x0", F.lit(False)).alias("in_training"))
