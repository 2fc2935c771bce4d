"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy, over all overlapping windows."""
from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.llm.common import bounded_batches, chunks, id_text

WINDOW, STRIDE = 32, 16
HIDDEN, ATTENTION = 8, 8
WORD_BUCKETS, WORD_SIZE = 1 << 14, 4
GRAM_BUCKETS, GRAM_SIZE = 1 << 15, 6
GRAMS = (3, 4, 5)
INPUT = WORD_SIZE + GRAM_SIZE
# The training sample: at most so many rows of each label, of texts of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 32_768
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 128, 0.01
THRESHOLD = 0.7
# Steps of a round at least; clean windows per toxic one at most.
STEPS, CLEAN_SHARE = 120, 3
WORDS_KEPT = 300_000
# Words whose character parts a task holds at once.
EMBEDDED_AT_ONCE = 1 << 13
PAD = b"\x00"  # no word holds it
SEED = 7

_TABLE = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII marks end a word."""
    return text.lower().encode().translate(_TABLE).split()


_STEPS = [np.random.default_rng(n).integers(1, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1) for n in GRAMS]


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, buckets of the character n-grams of all words in order (edges included), and their number per word."""
    own = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in words), np.int64, len(words))
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begins = np.cumsum(sizes) - sizes
    left = np.repeat(begins + sizes, sizes) - np.arange(len(data))  # bytes of the word from here on
    buckets, inside = np.zeros((len(data), len(GRAMS)), np.int64), left[:, None] >= np.array(GRAMS)
    for j, (n, steps) in enumerate(zip(GRAMS, _STEPS)):
        m = len(data) - n + 1
        if m > 0:
            mixed = sum(data[k:k + m] * steps[k] for k in range(n))
            buckets[:m, j] = (mixed * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BUCKETS.bit_length() + 1)
    return own, buckets[inside], np.add.reduceat(inside.sum(1), begins)


def windows(n: int) -> np.ndarray:
    """First words of the windows that cover ``n`` words; each but the last starts STRIDE after the one before."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


def _squash(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Network:
    """``words`` and ``grams`` embed; ``wx, u, b`` are the gates of both directions; ``a, v`` the attention; ``o, bias`` the output.

    ``scale, shift`` turn the highest logit of a document's windows into its score.
    """

    words: np.ndarray
    grams: np.ndarray
    wx: np.ndarray
    u: np.ndarray
    b: np.ndarray
    a: np.ndarray
    v: np.ndarray
    o: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    TRAINED = ("wx", "u", "b", "a", "v", "o", "bias")

    def embed(self, words: list[bytes]) -> np.ndarray:
        """Word part and mean of the character part, one row per word."""
        if not words:
            return np.zeros((0, INPUT), np.float32)
        own, flat, sizes = features(words)
        mean = np.add.reduceat(self.grams[flat], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]
        return np.concatenate([self.words[own], mean], axis=1).astype(np.float32)

    def project(self, embedded: np.ndarray) -> np.ndarray:
        """Input side of the gates, (direction, word, 3 * HIDDEN): worked out once per distinct word."""
        return np.matmul(embedded[None], self.wx) + self.b

    def run(self, table: np.ndarray, at: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """Logit of each window. ``at`` is (window, WINDOW), rows of ``table``; ``mask`` marks real words; ``keep`` gets what training needs."""
        n, steps, h = len(at), at.shape[1], np.zeros((2, len(at), HIDDEN), np.float32)
        out = np.empty((2, steps, n, HIDDEN), np.float32)
        x = np.empty((2, n, 3 * HIDDEN), np.float32)
        for t in range(steps):
            np.take(table[0], at[:, t], axis=0, out=x[0], mode="clip")
            np.take(table[1], at[:, steps - 1 - t], axis=0, out=x[1], mode="clip")
            hu = np.matmul(h, self.u)
            gates = _squash(x[:, :, :2 * HIDDEN] + hu[:, :, :2 * HIDDEN])
            r, z = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
            c = np.tanh(x[:, :, 2 * HIDDEN:] + r * hu[:, :, 2 * HIDDEN:])
            if mask is not None:
                z = z * np.stack([mask[:, t], mask[:, steps - 1 - t]])[:, :, None]
            new = h + z * (c - h)
            if keep is not None:
                keep.append((h, r, z, c, hu[:, :, 2 * HIDDEN:]))
            h = new
            out[0, t], out[1, steps - 1 - t] = h[0], h[1]
        both = np.concatenate([out[0], out[1]], axis=2)  # (step, window, 2 * HIDDEN)
        e = np.tanh(both @ self.a)
        weight = e @ self.v
        if mask is not None:
            weight = np.where(mask.T > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        if keep is not None:
            keep.append((both, e, weight, pooled))
        return pooled @ self.o + self.bias[0]

    def gradients(self, embedded: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of a batch of windows and its gradients, through all steps."""
        keep: list = []
        logit = self.run(self.project(embedded), at, mask, keep)
        both, e, weight, pooled = keep.pop()
        n, steps = at.shape
        p = 1 / (1 + np.exp(-logit))
        loss = float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))
        d = ((p - y) / n).astype(np.float32)
        g = {"o": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * self.o
        dboth = weight[:, :, None] * dpool
        dweight = np.einsum("nh,tnh->tn", dpool, both)
        dscore = weight * (dweight - (weight * dweight).sum(0))
        g["v"] = np.einsum("tn,tnk->k", dscore, e)
        de = dscore[:, :, None] * self.v * (1 - e * e)
        g["a"] = np.einsum("tnh,tnk->hk", both, de)
        dboth += de @ self.a.T
        for name in ("wx", "u", "b"):
            g[name] = np.zeros_like(getattr(self, name))
        carry = np.zeros((2, n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, r, z, c, hu = keep[t]
            m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[:, :, None]
            dh = np.stack([dboth[t, :, :HIDDEN], dboth[steps - 1 - t, :, HIDDEN:]]) + carry
            dz = dh * (c - h) * m
            dc = dh * z * (1 - c * c)
            gate = np.where(m > 0, z, 0)
            dz = dz * gate * (1 - gate)
            dr = dc * hu * r * (1 - r)
            dx = np.concatenate([dr, dz, dc], axis=2)
            dhu = np.concatenate([dr, dz, dc * r], axis=2)
            x = np.stack([embedded[at[:, t]], embedded[at[:, steps - 1 - t]]])
            g["wx"] += np.matmul(x.transpose(0, 2, 1), dx)
            g["b"] += dx.sum(1, keepdims=True)
            g["u"] += np.matmul(h.transpose(0, 2, 1), dhu)
            carry = dh * (1 - z) + np.matmul(dhu, self.u.transpose(0, 2, 1))
        return loss, g


def _new_network(rng: np.random.Generator) -> Network:
    def draw(*shape, by):
        return (rng.standard_normal(shape) * by).astype(np.float32)

    return Network(words=draw(WORD_BUCKETS, WORD_SIZE, by=0.3), grams=draw(GRAM_BUCKETS, GRAM_SIZE, by=0.3),
                   wx=draw(2, INPUT, 3 * HIDDEN, by=0.3), u=draw(2, HIDDEN, 3 * HIDDEN, by=0.3), b=np.zeros((2, 1, 3 * HIDDEN), np.float32),
                   a=draw(2 * HIDDEN, ATTENTION, by=0.3), v=draw(ATTENTION, by=0.3), o=draw(2 * HIDDEN, by=0.3), bias=np.zeros(1, np.float32))


def _cut(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (padded with row 0) and masks."""
    if len(ids) >= WINDOW:
        view = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[starts]
        return view, np.ones(view.shape, np.float32)
    at, mask = np.zeros((1, WINDOW), np.int64), np.zeros((1, WINDOW), np.float32)
    at[0, :len(ids)], mask[0, :len(ids)] = ids, 1
    return at, mask


def _log_odds(bags: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Log-odds of the label given that a feature occurs in a document; rare features count for less."""
    count = np.zeros((2, size))
    for bag, y in zip(bags, labels):
        count[int(y), bag] += 1
    totals = np.bincount(labels.astype(int), minlength=2)[:, None]
    odds = np.log((count[1] + 0.5) / (totals[1] + 1)) - np.log((count[0] + 0.5) / (totals[0] + 1))
    support = count.sum(0)
    return np.clip(odds * support / (support + 4), -3, 6).astype(np.float32)


def train(texts: list[str], labels: list[int], seed: int = SEED, weights: tuple[float, float] = (1.0, 1.0)) -> Network | None:
    """Fit a network on labelled texts; None if one label is missing. ``weights``: how many rows a text of label 0 and of label 1 stands for.

    Half of the texts give the embeddings their first dimension, the log-odds of words and n-grams. The other half train
    the recurrent part: a toxic text is taught by its highest window so far, a clean one by its two highest and by
    one at random; windows are chosen anew every round. The first half then calibrates the highest logit of a text,
    by ``weights``, so the score is at the shares of all rows.
    """
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    net = _new_network(rng)
    numbers: dict[bytes, int] = {PAD: 0}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int64) for t in texts]
    vocabulary = list(numbers)
    own, flat, sizes = features(vocabulary)
    grams = np.split(flat, np.cumsum(sizes)[:-1])
    order = rng.permutation(len(docs))
    first, second = order[::2], order[1::2]
    sets = [np.unique(d) for d in docs]
    net.words[:, 0] = _log_odds([np.unique(own[sets[k]]) for k in first], y[first], WORD_BUCKETS)
    net.grams[:, 0] = _log_odds([np.unique(np.concatenate([grams[i] for i in sets[k]] or [flat[:0]])) for k in first], y[first], GRAM_BUCKETS)
    embedded = net.embed(vocabulary)
    embedded[0] = 0
    guess = embedded[:, 0] + embedded[:, WORD_SIZE]

    usable = [k for k in second if len(docs[k])]
    cuts = {k: _cut(docs[k], windows(len(docs[k]))) for k in {*usable, *(k for k in first if len(docs[k]))}}
    state = {name: [np.zeros_like(getattr(net, name)), np.zeros_like(getattr(net, name))] for name in Network.TRAINED}
    step = 0
    for turn in range(ROUNDS):
        at, mask, target = [], [], []
        scores = _score_cuts(net, embedded, [cuts[k] for k in usable]) if turn else [(guess[cuts[k][0]] * cuts[k][1]).max(1) for k in usable]
        for k, s in zip(usable, scores):
            chosen = {int(np.argmax(s))} if y[k] else {*np.argsort(-s)[:2].tolist(), int(rng.integers(len(s)))}
            for i in chosen:
                at.append(cuts[k][0][i])
                mask.append(cuts[k][1][i])
                target.append(y[k])
        at, mask, target = np.array(at), np.array(mask), np.array(target, np.float32)
        toxic = np.flatnonzero(target)
        again = int((len(target) - len(toxic)) / (CLEAN_SHARE * max(1, len(toxic))))
        shown = np.concatenate([np.arange(len(target)), *[toxic] * max(0, again - 1)])
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(shown)))):
            for part in np.array_split(rng.permutation(shown), max(1, len(shown) // BATCH)):
                _, g = net.gradients(embedded, at[part], mask[part], target[part])
                step += 1
                for name, grad in g.items():
                    m, v = state[name]
                    grad = np.clip(grad, -1, 1)
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    value = getattr(net, name)
                    value -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    held = [k for k in first if len(docs[k])]
    top = np.array([s.max() for s in _score_cuts(net, embedded, [cuts[k] for k in held])])
    net.scale, net.shift = _calibrate(top, y[held], np.where(y[held] > 0, weights[1], weights[0]))
    return net


def _score_cuts(net: Network, embedded: np.ndarray, cuts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    table = net.project(embedded)
    sizes = [len(at) for at, _ in cuts]
    at, mask = (np.concatenate([c[k] for c in cuts]) for k in (0, 1))
    logits = np.concatenate([net.run(table, at[i:i + 2048], mask[i:i + 2048]) for i in range(0, len(at), 2048)])
    return np.split(logits, np.cumsum(sizes)[:-1])


def _calibrate(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> tuple[float, float]:
    """Logistic fit of the label to the highest logit, by Newton's method with a weak prior; ``rows``: how many rows each stands for."""
    share = np.ones(len(x)) if rows is None else rows * (len(rows) / rows.sum())
    middle, spread = x.mean(), x.std() + 1e-6
    z, w = np.stack([(x - middle) / spread, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.clip(np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(2), z.T @ (share * (p - y)) + np.array([0.5, 0]) * w), -1, 1)
    scale = max(float(w[0] / spread), 1e-3)
    return scale, float(w[1] - w[0] * middle / spread)


def fit(docs: DataFrame, labels: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Train on a bounded sample: at most ``rows`` rows per label, in an order by hash of the id, of texts of at most ``max_bytes``.

    Both labels are counted over all training rows, and the score is calibrated at their true shares.
    ``in_training`` is a condition on the column ``doc_id`` of the labels. Of several labels of one id the highest counts.
    """
    marks = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(in_training).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = [marks.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    body = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), body.alias("body")).filter(F.octet_length("body") <= max_bytes)
    sample = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id").agg(F.min("body").alias("body"), F.max("label").alias("label"))
    found = sorted(sample.toLocalIterator(), key=lambda r: r["doc_id"])
    there = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    weights = tuple(max(1.0, there.get(k, 0) / rows) for k in (0, 1))
    return train([r["body"] for r in found], [r["label"] for r in found], weights=weights)


class _Scorer:
    """Scores texts in a task; input projections of words are remembered."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {PAD: 0}
        self.table = np.zeros((2, WORDS_KEPT, 3 * HIDDEN), np.float32)  # pages not written to take no memory

    def __call__(self, texts: list[str]) -> list[float]:
        docs = [words_of(t) for t in texts]
        new = list(set().union(*docs).difference(self.numbers))
        if len(self.numbers) + len(new) > WORDS_KEPT:
            self._forget()
            new = list(set().union(*docs))
        begin = len(self.numbers)
        if begin + len(new) > self.table.shape[1]:
            self.table = np.zeros((2, begin + len(new), 3 * HIDDEN), np.float32)
        for a in range(0, len(new), EMBEDDED_AT_ONCE):
            some = new[a:a + EMBEDDED_AT_ONCE]
            self.table[:, begin + a:begin + a + len(some)] = self.net.project(self.net.embed(some))
        self.numbers.update(zip(new, range(begin, begin + len(new))))
        get = self.numbers.__getitem__
        at, mask, owner, short = [], [], [], []
        for k, words in enumerate(docs):
            if not words:
                continue
            a, m = _cut(np.fromiter(map(get, words), np.int64, len(words)), windows(len(words)))
            at.append(a)
            mask.append(m)
            owner.append(np.full(len(a), k))
            short.append(np.full(len(a), len(words) < WINDOW))
        top = np.full(len(texts), -np.inf)
        if at:
            at, mask, owner, short = map(np.concatenate, (at, mask, owner, short))
            for some in (np.flatnonzero(~short), np.flatnonzero(short)):
                for i in range(0, len(some), 2048):
                    part = some[i:i + 2048]
                    logit = self.net.run(self.table, at[part], mask[part] if short[part[0]] else None)
                    np.maximum.at(top, owner[part], logit)
        with np.errstate(over="ignore"):
            return (1 / (1 + np.exp(-(self.net.scale * top + self.net.shift)))).tolist()


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, tag, score)`` of every row: the highest window of the whole text, calibrated; ``tag`` is a hash of the text.

    NULL and empty texts and texts without words score 0; so does everything if there was nothing to learn from.
    Repeated and NULL ids are rows like any other.
    """
    rows = id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("body"))
    if net is None:
        return rows.select(F.col("id").alias("doc_id"), "tag", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            got = [s for _, bodies in chunks([batch]) for s in scorer([b.decode() for b in bodies])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.float64())], ["doc_id", "tag", "score"])

    return rows.mapInArrow(run, "doc_id bigint, tag bigint, score double")


def rate_toxicity(docs: DataFrame, labels: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row, by a network fitted on the labelled rows where ``in_training`` holds."""
    net = fit(docs, labels, in_training, id_col, text_col, **settings)
    return score(docs, net, id_col, text_col).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns and other rows as they are.

    Every row is scored where it is read and passed on or not: nothing is shuffled or joined. NULL and empty texts stay, and
    so does everything if there was nothing to learn from; NULL and repeated ids and repeated rows are judged by their own text.
    """
    net = fit(docs, labels, in_training, id_col, text_col, **settings)
    if net is None:
        return docs
    bounded_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index(text_col)  # a fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            text = batch.column(at).cast(pa.string()).fill_null("").cast(pa.binary())
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), text], ["id", "body"])
            got = [s for _, bodies in chunks([rows]) for s in scorer([b.decode() for b in bodies])]
            yield batch.filter(pa.array([s < THRESHOLD for s in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
