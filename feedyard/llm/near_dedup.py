"""Near-duplicates: banded MinHash candidates, pruned by sequential Bayesian verification, confirmed on full shingle sets."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from feedyard.llm.common import chunks, id_text, written
from feedyard.llm.components import components
from feedyard.session import stable, work_dir

WORDS = 5
SIMILARITY = (3, 4)  # at least three quarters
BAND_BITS = 5  # the low bits of a bucket's key name its band
ROWS, BANDS = 4, 1 << BAND_BITS  # a pair of similarity 0.75 shares no band with probability (1 - 0.75 ** 4) ** 32 < 6e-6
HASHES = ROWS * BANDS
BATCH = 16  # signature rows compared at a time
MISS = 1e-7  # a pair is pruned when the posterior probability of enough similarity falls below this
BLOCK = 1024  # members of a bucket that meet as one block inside a task
BLOCK_SHINGLES = 1 << 21  # shingles (16 MB) that the members of a block hold together, a longer text aside
PAIRS = 1 << 15  # pairs of a group looked at together; those that signatures leave are held with both signatures (32 MB)
BROADCAST_IDS = 250_000  # so many node numbers (2 MB) at most are sent to every executor; more are joined by shuffle
SEED = 20_231
MEMO, MEMO_WORD = 100_000, 32  # word hashes remembered per Python worker, of words of so many bytes


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO and len(word) <= MEMO_WORD:
            self[word] = h
        return h


_HASHES = _WordHashes()
_PLACE = np.random.default_rng(SEED).integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(SEED + 1).integers(1, 1 << 63, (HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(body: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; bytes lower A-Z alone and split at ASCII white space alone."""
    words = body.lower().split()
    codes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if len(codes) == 0:
        return codes
    if len(codes) < WORDS:
        whole = np.uint64(len(codes)) + (codes * _PLACE[:len(codes)]).sum(dtype=np.uint64)
        return _scramble(np.array([whole]))
    n = len(codes) - WORDS + 1
    total = codes[:n] * _PLACE[0]
    for k in range(1, WORDS):
        total += codes[k:k + n] * _PLACE[k]
    return np.unique(_scramble(total))


def signature(hashes: np.ndarray) -> bytes:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 512):
        np.minimum(least, (_MIX * hashes[a:a + 512]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def least_matches(t: float = SIMILARITY[0] / SIMILARITY[1], miss: float = MISS) -> list[int]:
    """After each batch of rows, the fewest matches with which a pair goes on.

    With a uniform prior the similarity given ``m`` matches of ``n`` is Beta(m + 1, n - m + 1), whose upper tail at ``t`` is
    the chance of at most ``m`` successes of ``n + 1`` at ``t``.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _signatures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for _, bodies in chunks([batch]):
            for s in map(shingles, bodies):
                found.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s)) if len(s) else (0, None, None))
        sizes, digests, signatures = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                          pa.array(signatures, pa.binary())], ["id", "tag", "n", "digest", "sig"])


def _prune(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, sig_a, sig_b) whose posterior stays above the bound after every batch of rows."""
    least = least_matches()
    for batch in batches:
        if not batch.num_rows:
            continue
        one, other = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u4").reshape(-1, HASHES) for k in (2, 3))
        alive, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
        for step, need in enumerate(least):
            at = slice(step * BATCH, (step + 1) * BATCH)
            matches[alive] += (one[alive, at] == other[alive, at]).sum(axis=1)
            alive = alive[matches[alive] >= need]
        yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(alive)) for k in (0, 1)], ["a", "b"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, own, hashes)`` of each text, some texts at a time; a set goes into its column without a copy in between."""
    for ids, bodies in chunks(batches):
        found = [shingles(b) for b in bodies]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in found], pa.binary()),
            pa.array(map(memoryview, found), pa.binary())], ["node", "own", "hashes"])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    both = int((y.take(np.searchsorted(y, x), mode="clip") == x).sum())
    return SIMILARITY[1] * both >= SIMILARITY[0] * (len(x) + len(y) - both)


def _confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, hashes_a, hashes_b) that are similar enough on their full sets."""
    for batch in batches:
        ok = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3))]
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])


class _Corpus:
    """Rows, their distinct shingle sets (nodes) and what it takes to compare two nodes; all in tables of the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        spark = docs.sparkSession
        self.texts = id_text(docs, id_col, text_col)
        folder = work_dir(spark, "near-dedup")
        self.texts.withColumn("tag", F.xxhash64("body")).mapInArrow(_signatures, "id bigint, tag bigint, n bigint, digest binary, sig binary").write.parquet(f"{folder}/rows")
        self.rows = spark.read.parquet(f"{folder}/rows")
        distinct = self.rows.filter("digest is not null").groupBy("digest").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        distinct.withColumn("node", F.monotonically_increasing_id()).write.parquet(f"{folder}/nodes")
        self.nodes = spark.read.parquet(f"{folder}/nodes")

    def pick(self, table: DataFrame, wanted: DataFrame, on) -> DataFrame:
        """``table`` joined to a counted list of wanted nodes; a short list is broadcast, so the table is not shuffled."""
        return table.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, on)

    def side(self, table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def sets(self, ids: DataFrame) -> DataFrame:
        """``(node, hashes)`` of the nodes in ``ids(node)``, made from their texts."""
        wanted = stable(self.pick(self.nodes.select("node", "low", "digest"), ids, "node"))
        texts = self.pick(self.texts, wanted.select("node", "low"), F.col("id").eqNullSafe(F.col("low")))
        sets = texts.select("node", "body").mapInArrow(_sets, "node bigint, own binary, hashes binary")
        # an id may repeat with other texts, and repeated rows give a set twice
        return sets.join(wanted.select("node", "digest"), "node").filter("own = digest").select("node", "hashes").dropDuplicates(["node"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct ``pairs(a, b)`` that are similar enough."""
        near = stable(self.pick(self.nodes.select("node", "n", "sig"), _ends(pairs), "node"))
        met = pairs.join(self.side(near, "a", "n", "sig"), "a").join(self.side(near, "b", "n", "sig"), "b")
        met = met.filter(SIMILARITY[1] * F.least("n_a", "n_b") >= SIMILARITY[0] * F.greatest("n_a", "n_b"))
        alive = stable(met.select("a", "b", "sig_a", "sig_b").mapInArrow(_prune, "a bigint, b bigint"))
        sets = stable(self.sets(_ends(alive)))
        full = alive.join(self.side(sets, "a", "hashes"), "a").join(self.side(sets, "b", "hashes"), "b")
        return stable(full.select("a", "b", "hashes_a", "hashes_b").mapInArrow(_confirm, "a bigint, b bigint"))

    def bands(self) -> DataFrame:
        """``(key, node, n)``, one row per band."""
        size = 4 * ROWS

        def key(k):
            return F.shiftleft(F.xxhash64(F.col("sig").substr(k * size + 1, F.lit(size))), BAND_BITS).bitwiseOR(k.cast("bigint"))

        return self.nodes.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), key)).alias("key"), "node", "n")

    def across(self, members: DataFrame) -> DataFrame:
        """Links ``(a, b)`` between different components of a bucket of ``members(key, node, n, root)``: enough of them to join all that are linked.

        The members of a bucket are dealt into blocks, and every two blocks meet in one call, so a bucket of m members is sent
        about m / BLOCK times. The first meeting is on signatures alone and leaves the members that some pair needs;
        the second has their full sets, which the signatures follow from, and confirms pairs, most alike first, leaving out those that links found there already join. Pairs never become rows.
        A pair is looked at in the first band that it shares, once.
        """
        held = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("held"), F.sum("n").alias("weight"))
        held = held.filter("low <> high").select("key", F.ceil(F.greatest(F.col("held") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        rows = members.join(held, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        rows = rows.join(self.nodes.select("node", "sig"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "n", "sig")
        met = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        suspects = stable(met.mapInArrow(_suspects, "key bigint, i int, j int, own int, node bigint, root bigint, n bigint"))
        ids = stable(suspects.select("node").distinct())
        met = suspects.join(stable(self.sets(ids)), "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return stable(met.select("key", "i", "j", "own", "node", "root", "n", "hashes").mapInArrow(_settle, "a bigint, b bigint"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (key, i, j); the input is sorted by these."""
    at, held = None, []
    for batch in batches:
        named = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
        edges = [0, *(np.flatnonzero((named[1:] != named[:-1]).any(axis=1)) + 1).tolist(), len(named)]
        for begin, end in zip(edges, edges[1:]):
            if begin == end:
                continue
            here = tuple(named[begin].tolist())
            if here != at and held:
                yield pa.Table.from_batches(held)
                held = []
            at = here
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions of pairs of different components that signatures do not rule out, with their matches; of one block or of two, in pieces of bounded size."""
    own, root, n = (group.column(c).to_numpy() for c in ("own", "root", "n"))
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(-1, HASHES)
    band = group.column("key")[0].as_py() % BANDS
    same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
    first = own == group.column("i")[0].as_py()
    left, right = np.flatnonzero(first), np.arange(len(own)) if same else np.flatnonzero(~first)
    least = least_matches()
    step = max(1, PAIRS // max(1, len(right)))
    for begin in range(0, len(left), step):
        some = left[begin:begin + step]
        can = root[some][:, None] != root[right][None, :]
        can &= SIMILARITY[1] * np.minimum(n[some][:, None], n[right][None, :]) >= SIMILARITY[0] * np.maximum(n[some][:, None], n[right][None, :])
        if same:
            can &= some[:, None] < right[None, :]
        i, j = np.nonzero(can)
        i, j = some[i], right[j]
        matches = np.zeros(len(i), np.int64)
        for k, need in enumerate(least):
            at = slice(k * BATCH, (k + 1) * BATCH)
            matches += (sig[i, at] == sig[j, at]).sum(axis=1)
            alive = matches >= need
            i, j, matches = i[alive], j[alive], matches[alive]
        shared = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(axis=2)
        mine = shared.argmax(axis=1) == band
        yield i[mine], j[mine], matches[mine]


def _suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those rows of each group that stand in some pair which signatures do not rule out."""
    for group in _groups(batches):
        needed = np.zeros(len(group), bool)
        for i, j, _ in _candidates(group):
            needed[i] = needed[j] = True
        if needed.any():
            yield from group.filter(pa.array(needed)).drop_columns(["sig"]).combine_chunks().to_batches()


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the components of each group, confirmed on full sets; at most one fewer than the group has components."""
    for group in _groups(batches):
        node, root = group.column("node").to_numpy(), group.column("root").to_numpy()
        parts, part = np.unique(root, return_inverse=True)
        up = list(range(len(parts)))
        sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in group.column("hashes")]  # not copied
        group = group.append_column("sig", pa.array(map(signature, sets), pa.binary()))

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        i, j, matches = (np.concatenate(x) for x in zip(*_candidates(group)))
        likely = np.argsort(-matches, kind="stable")
        links = []
        for x, y in zip(i[likely].tolist(), j[likely].tolist()):
            one, other = find(part[x]), find(part[y])
            if one != other and _similar(sets[x], sets[y]):
                up[one] = other
                links.append((max(node[x], node[y]), min(node[x], node[y])))
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, tag)`` of every row; ``tag`` is a hash of the text.

    Rows with one shingle set are one node. Every node is compared with two members of each of its buckets: the
    smallest by number and the smallest by hash. Both orders are the same in all buckets, so a large group of near
    copies meets few leaders however many bands it shares. What is left in different components of one bucket meets inside tasks,
    block against block, where pairs are pruned on signatures and confirmed on full sets; only links that join components
    become rows. So no component is left apart from another that it is linked with, and no group is expanded into its pairs.

    NULL and empty texts, and texts of white space, have no shingles and are linked with nothing: each is its own
    component. ``component_id`` is the smallest id of the component, NULL ids aside; it is NULL, and the row kept, where
    all ids are NULL. Repeated rows get equal results; rows of one id and different texts are judged apart.
    """
    corpus = _Corpus(docs, id_col, text_col)
    bands = corpus.bands()
    leaders = bands.groupBy("key").agg(F.min("node").alias("first"), F.min(F.struct(F.xxhash64("node"), "node")).alias("drawn"),
                                       F.count(F.lit(1)).alias("held")).filter("held > 1")
    members = stable(bands.join(leaders, "key").select("key", "node", "n", "first", F.col("drawn.node").alias("drawn")))
    met = members.select("node", F.explode(F.array("first", "drawn")).alias("other")).filter("node <> other")
    compared = stable(met.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct())
    links = corpus.links(compared)
    root = components(links)

    labelled = members.select("key", "node", "n").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = corpus.across(labelled)
    if not found.isEmpty():
        root = components(links.union(found))

    low = root.join(corpus.nodes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component"))
    verdict = corpus.nodes.select("node", "digest", "low").join(root, "node", "left").join(low, "root", "left").select(
        "digest", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("component")).alias("component"))
    out = corpus.rows.select("id", "tag", "n", "digest").join(verdict, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "tag")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; columns and other rows as they are. Repeated rows of the one that stays all stay."""
    bad = near_components(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("_llm_id"), F.col("tag").alias("_llm_tag")).distinct()
    bad = written(bad, "near-copies")  # a table of known size: a short one is broadcast, so documents are not shuffled
    return docs.join(bad, docs[id_col].cast("bigint").eqNullSafe(bad["_llm_id"])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit("")).cast("binary")) == bad["_llm_tag"]), "left_anti")
