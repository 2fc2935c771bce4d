"""Benchmark decontamination: training words are streamed through a generalised suffix automaton of the test items."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedyard.llm.common import id_text, written

WINDOW = 13
# Words of test items in one automaton (some 100 MB in a task); more items make more automata, each over all documents.
BLOCK_WORDS = 100_000
# A document is contaminated from this share of hit words on, as 1 / COVERAGE.
COVERAGE = 20

# Bytes outside words become spaces, A-Z become a-z; bytes of letters beyond ASCII stay.
_TABLE = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word numbers.

    State 0 is the root. ``grow`` adds one sequence; a state stands for all strings that end at the same places of all
    sequences, the longest of which has ``length[state]`` words; ``link`` leads to the state of its next shorter suffixes.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, origin: int, word: int, target: int) -> int:
        """The part of ``target`` that is no longer than what ends at ``origin`` plus one word, as a state of its own."""
        copy = self._state(self.length[origin] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while origin >= 0 and self.next[origin].get(word) == target:
            self.next[origin][word] = copy
            origin = self.link[origin]
        return copy

    def grow(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            known = self.next[last].get(word)
            if known is not None:  # another sequence has been here
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
                continue
            new, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                target = self.next[at][word]
                self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
            last = new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and length of the longest suffix of the stream that occurs in a sequence, after one more word."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return self.next[state][word], matched + 1

    def suffix(self, state: int, size: int) -> int:
        """State of the suffix of ``size`` words of what ends at ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


class Matcher:
    """Finds windows of test items in documents; items are ``(item_id, words)``."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        items = [(i, w) for i, w in items if w]
        self.window = window
        self.numbers = {w: k for k, w in enumerate({w for _, ws in items for w in ws})}
        self.sam = SuffixAutomaton()
        coded = [(i, [self.numbers[w] for w in ws]) for i, ws in items]
        for _, seq in coded:
            self.sam.grow(seq)
        # state -> items, by the length of the window that ends there: `window`, or a whole shorter item
        self.full: dict[int, set[str]] = {}
        self.short: dict[tuple[int, int], set[str]] = {}
        for item, seq in coded:
            state, matched = 0, 0
            for word in seq:
                state, matched = self.sam.step(state, matched, word)
                if matched >= window:
                    self.full.setdefault(self.sam.suffix(state, window), set()).add(item)
            if len(seq) < window:
                self.short.setdefault((self.sam.suffix(state, len(seq)), len(seq)), set()).add(item)
        self.short_sizes = sorted({size for _, size in self.short})
        self.least = min([window, *self.short_sizes])

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first word, end) in order, merged where they touch, and the items that have an occurring window."""
        codes = np.fromiter((self.numbers.get(w, -1) for w in words), np.int64, len(words))
        # only runs of words that items use can hold a window
        known = np.concatenate([[0], (codes >= 0).view(np.int8), [0]])
        edges = np.diff(known)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for begin, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            if end - begin < self.least:
                continue
            state, matched = 0, 0
            for at, word in enumerate(codes[begin:end].tolist(), int(begin) + 1):
                state, matched = self.sam.step(state, matched, word)
                size = 0
                if matched >= self.window:
                    items |= self.full[self.sam.suffix(state, self.window)]
                    size = self.window
                for short in self.short_sizes:
                    if short > matched:
                        break
                    found = self.short.get((self.sam.suffix(state, short), short))
                    if found:
                        items |= found
                        size = max(size, short)
                if size:
                    first = at - size
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append((first, at))
        return spans, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words (a longer item alone); one partition at a time reaches the driver."""
    block, held = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    for item, body in rows.toLocalIterator():
        words = words_of(bytes(body))
        if item is None or not words:
            continue
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((item, words))
        held += len(words)
    if block:
        yield block


def find_windows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, tag, n_words, spans array<struct<first, end>>, items array<string>)`` of every row, in words.

    ``tag`` is a hash of the text. A window is ``window`` consecutive words of an item, or a whole shorter item. Each
    block of items is broadcast as bounded text and every task builds its automaton; with several blocks the spans of
    a row are put together again by id and tag.
    """
    sc = docs.sparkSession.sparkContext
    rows = id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("body"))
    kind = "doc_id bigint, tag bigint, n_words bigint, spans array<struct<first:int,end:int>>, items array<string>"
    arrow = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())]

    def finder(block):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block.value, window)
            for batch in batches:
                out = []
                for i, body, tag in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words = words_of(body)
                    spans, items = matcher.match(words)
                    out.append((i, tag, len(words), [{"first": a, "end": b} for a, b in spans], sorted(items)))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow)], ["doc_id", "tag", "n_words", "spans", "items"])
        return run

    found = [rows.mapInArrow(finder(sc.broadcast(block)), kind) for block in _blocks(benchmark, item_col, item_text_col, block_words)]
    if not found:
        found = [rows.mapInArrow(finder(sc.broadcast([])), kind)]
    if len(found) == 1:
        return found[0]
    first = found[0].select("doc_id", "tag", "n_words")
    more = None
    for part in found:
        part = part.filter(F.size("spans") > 0).select("doc_id", "tag", "spans", "items")
        more = part if more is None else more.union(part)
    more = more.groupBy("doc_id", "tag").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("raw"),
                                             F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = F.aggregate(
        "raw", F.expr("cast(array() as array<struct<first:int,end:int>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (x["first"] <= F.element_at(acc, -1)["end"]),
                              F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))
                              ).otherwise(F.concat(acc, F.array(x))))
    more = more.select(F.col("doc_id").alias("m_id"), F.col("tag").alias("m_tag"), merged.alias("spans"), "items")
    none = F.expr(f"cast(array() as {'array<struct<first:int,end:int>>'})")
    return first.join(more, first["doc_id"].eqNullSafe(more["m_id"]) & (first["tag"] == more["m_tag"]), "left").select(
        "doc_id", "tag", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_hit, items array<string>, spans, contaminated)`` of every row.

    A word inside any occurrence of a window is hit; a document is contaminated if it has a hit word and ``coverage``
    times the hit words reach its words. NULL and empty texts have no words. Items without id or words are passed over;
    an item listed twice counts once. With an empty benchmark nothing is hit.
    """
    hits = find_windows(docs, benchmark, id_col, text_col, item_col, item_text_col, window, block_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + (x["end"] - x["first"]).cast("bigint"))
    return hits.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", "items", "spans", ((F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "tag")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without contaminated rows; columns and other rows as they are."""
    bad = decontaminate(docs, benchmark, id_col, text_col, **settings).filter("contaminated").select(
        F.col("doc_id").alias("_llm_id"), F.col("tag").alias("_llm_tag")).distinct()
    bad = written(bad, "contaminated")  # a table of known size: a short one is broadcast, so documents are not shuffled
    return docs.join(bad, docs[id_col].cast("bigint").eqNullSafe(bad["_llm_id"])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit("")).cast("binary")) == bad["_llm_tag"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, max_length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(doc_id, text, n_removed)`` of every row: hit spans of at least ``max_length`` words, and all hit spans of a contaminated row, are cut out of the text."""
    rows = id_text(docs, id_col, text_col).withColumn("own_tag", F.xxhash64("body"))
    hits = decontaminate(docs, benchmark, id_col, text_col, **settings).filter("n_hit > 0").select(
        F.col("doc_id").alias("own_id"), "tag", F.when(F.col("contaminated"), F.col("spans")).otherwise(
            F.filter("spans", lambda x: x["end"] - x["first"] >= max_length)).alias("spans")).dropDuplicates(["own_id", "tag"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for body, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                places = _places(body) if spans else []
                out, at = [], 0
                for s in spans or ():
                    out.append(body[at:places[s["first"]][0]])
                    at = places[s["end"] - 1][1]
                texts.append(b"".join([*out, body[at:]]).decode())
                removed.append(sum(s["end"] - s["first"] for s in spans or ()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], ["doc_id", "text", "n_removed"])

    joined = rows.join(hits, rows["id"].eqNullSafe(hits["own_id"]) & (rows["own_tag"] == hits["tag"]), "left")
    return joined.select("id", "body", "spans").mapInArrow(cut, "doc_id bigint, text string, n_removed bigint")


def _places(body: bytes) -> list[tuple[int, int]]:
    """First byte and end of each word."""
    inside = np.concatenate([[0], (np.frombuffer(body.translate(_TABLE), np.uint8) != 32).view(np.int8), [0]])
    edges = np.diff(inside)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
