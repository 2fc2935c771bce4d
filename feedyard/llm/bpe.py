"""Byte-level BPE encoding and decoding; the merges of a word are driven by a segment tree over its adjacent pairs."""
from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedyard.llm.common import chunks, id_text

# White space as Unicode defines it, and the contractions that the vocabulary's splitting rule names.
SPACES = " \t\n\x0b\x0c\r\x85\xa0  -     　"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Bytes of encoded words kept per Python worker, whatever their lengths; beyond it the store starts anew.
BYTES_KEPT = 24 << 20
# Unknown words that texts wait for at most, but for those of one text, before they are merged.
WORDS_WAITING = 30_000
NONE = np.int64(1) << 60  # no mergeable pair


def byte_letters() -> list[str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class WordSplitter:
    """Cuts text into the words within which merges happen.

    ``re`` has no Unicode letter and number classes, so the classes name the letters and numbers met so far; a text
    with a new one extends them.
    """

    def __init__(self) -> None:
        self.known: set[str] = set()
        self.letters: list[str] = []
        self.numbers: list[str] = []
        self._compile()

    def _compile(self) -> None:
        letters = "A-Za-z" + "".join(map(re.escape, self.letters))
        numbers = "0-9" + "".join(map(re.escape, self.numbers))
        self.find = re.compile(
            f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        ).findall

    def __call__(self, text: str) -> list[str]:
        if not text.isascii():
            new = {c for c in set(text) - self.known if c > "\x7f"}
            if new:
                self.known |= new
                self.letters += sorted(c for c in new if unicodedata.category(c)[0] == "L")
                self.numbers += sorted(c for c in new if unicodedata.category(c)[0] == "N")
                self._compile()
        return self.find(text)


class BytePairCodec:
    """Encodes and decodes with a tokenizer file of byte-level BPE (JSON with vocabulary, merges and added tokens)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        left, right, made = (np.array([vocab[x] for x in side], np.int64)
                             for side in ([p[0] for p in pairs], [p[1] for p in pairs], [a + b for a, b in pairs]))
        key = left * self.width + right
        order = np.argsort(key, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_made = key[order], order.astype(np.int64), made[order]
        self.pairs = dict(zip(self.pair_keys.tolist(), zip(self.pair_ranks.tolist(), self.pair_made.tolist())))
        back = {c: b for b, c in enumerate(letters)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.stop = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.split = WordSplitter()
        self.decimal = [str(i) for i in range(size)]
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.held = 0

    # -- merges ---------------------------------------------------------------------------------------------------

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE if it does not merge) and the token that it makes."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], NONE), self.pair_made[at]

    def _merge_many(self, words: list[bytes], leaves: int) -> list[np.ndarray]:
        """Ids of words of at most ``leaves`` bytes, one segment tree per word, all trees stepping together.

        Leaf ``p`` holds ``rank * leaves + p`` of the pair that starts at position ``p``; a node holds the least of its
        children, so the root names the leftmost pair of lowest rank. A merge changes three leaves: the pair itself,
        the one before it and the one it swallowed; each climbs to the root in log2(leaves) steps. All arrays are flat;
        position ``leaves`` of each word is a blank that no pair reaches.
        """
        n, span = len(words), leaves + 1
        length = np.fromiter(map(len, words), np.int64, n)
        ids = np.full((n, span), -1, np.int64)
        ids[np.arange(span) < length[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        rank, _ = self._rank(ids[:, :-1], ids[:, 1:])
        ok = (rank < NONE) & (np.arange(1, span) < length[:, None])
        tree[:, leaves:] = np.where(ok, rank * leaves + np.arange(leaves), NONE)
        for node in range(leaves - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        after = np.tile(np.minimum(np.arange(1, span + 1), leaves), n)
        before = np.tile(np.arange(-1, leaves), n)
        ids, tree = ids.ravel(), tree.ravel()

        def put(root: np.ndarray, p: np.ndarray, value: np.ndarray) -> None:
            node = p + leaves
            tree[root + node] = value
            for _ in range(leaves.bit_length() - 1):
                node = node >> 1
                pair = root + 2 * node
                tree[root + node] = np.minimum(tree[pair], tree[pair + 1])

        def pair(word: np.ndarray, root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
            right = ids[word + q]
            rank, _ = self._rank(ids[word + p], right)
            put(root, p, np.where((right >= 0) & (rank < NONE), rank * leaves + p, NONE))

        live = np.flatnonzero(tree[1::2 * leaves] < NONE)
        while len(live):
            word, root = live * span, live * 2 * leaves
            p = tree[root + 1] % leaves
            q = after[word + p]
            _, made = self._rank(ids[word + p], ids[word + q])
            nxt = after[word + q]
            ids[word + p] = made
            ids[word + q] = -1
            after[word + p] = nxt
            before[word + nxt] = p
            swallowed = q < leaves
            put(root[swallowed], q[swallowed], np.full(int(swallowed.sum()), NONE))
            pair(word, root, p, nxt)
            prev = before[word + p]
            has = prev >= 0
            pair(word[has], root[has], prev[has], p[has])
            live = live[tree[root + 1] < NONE]
        ids = ids.reshape(n, span)
        there = ids >= 0
        return np.split(ids[there], np.cumsum(there.sum(1))[:-1])

    def _merge_one(self, word: bytes) -> list[int]:
        """The same tree for a single long word, in plain integers."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n, width, pairs, none = len(ids), int(self.width), self.pairs, int(NONE)
        leaves = 1 << max(1, (n - 1).bit_length())
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * leaves)

        def leaf(p: int, q: int) -> int:
            found = pairs.get(ids[p] * width + ids[q]) if q < n else None
            return none if found is None else found[0] * leaves + p

        def put(p: int, value: int) -> None:
            node = p + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        for p in range(n - 1):
            tree[leaves + p] = leaf(p, p + 1)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            p = tree[1] % leaves
            q = after[p]
            ids[p] = pairs[ids[p] * width + ids[q]][1]
            ids[q] = -1
            after[p] = after[q]
            if after[p] < n:
                before[after[p]] = p
            put(q, none)
            put(p, leaf(p, after[p]))
            if before[p] >= 0:
                put(before[p], leaf(before[p], p))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(1 << max(1, (len(w) - 1).bit_length()), []).append(i)
        for leaves, members in by_size.items():
            step = max(1, (1 << 15) // leaves)
            if leaves > 256 or len(members) < 4:
                for i in members:
                    out[i] = np.array(self._merge_one(words[i]), np.int64)
                continue
            for a in range(0, len(members), step):
                part = members[a:a + step]
                for i, ids in zip(part, self._merge_many([words[i] for i in part], leaves)):
                    out[i] = ids
        return out

    # -- texts ----------------------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Words of a text in order; an added token stands as one word."""
        if self.stop is None or not any(t in text for t in self.added):
            return self.split(text)
        out: list[str] = []
        for part in self.stop.split(text):
            out += [part] if part in self.added else self.split(part)
        return out

    def merge_words(self, words: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.merge([w.encode() for w in words])]

    def _keep(self, word: str, ids: list[int]) -> None:
        packed = np.array(ids, self.kind).tobytes()
        self.known[word] = packed
        self.held += sys.getsizeof(word) + sys.getsizeof(packed) + 32

    def _settle(self, waiting: list[tuple[list, list[tuple[int, str]]]]) -> None:
        """Merge the words that the texts wait for, all together, and put their ids in."""
        new = list({word for _, gaps in waiting for _, word in gaps})
        for word, ids in zip(new, self.merge_words(new)):
            self._keep(word, ids)
        for ids, gaps in waiting:
            for i, word in gaps:
                ids[i] = self.known[word]

    def pack_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text. Words met before are looked up; the others of many texts are merged together.

        Words are kept as the bytes of their ids, and of a split text only the words not yet known outlive it.
        """
        if self.held > BYTES_KEPT:
            self.known.clear()
            self.held = 0
        if not self.known:
            for token, i in self.added.items():
                self._keep(token, [i])
        get = self.known.get
        out, waiting, count = [], [], 0
        for text in texts:
            words = self.words(text)
            ids = list(map(get, words))
            out.append(ids)
            if None in ids:
                gaps = [(i, words[i]) for i, x in enumerate(ids) if x is None]
                waiting.append((ids, gaps))
                count += len(gaps)
            if count >= WORDS_WAITING:
                self._settle(waiting)
                waiting, count = [], 0
        self._settle(waiting)
        return [b"".join(ids) for ids in out]

    def unpack(self, packed: bytes) -> list[int]:
        return np.frombuffer(packed, self.kind).tolist()

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [self.unpack(x) for x in self.pack_many(texts)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """One codec per file and Python worker."""
    return BytePairCodec(path)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` of every row; ``tokenizer`` is the path of the file on each executor.

    The text is encoded whole and the ids are decoded again. NULL and empty texts have no ids and an empty decoded
    text. Ids may be NULL or repeat; each row gives one row. An added token that occurs in a text is that token.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for ids, bodies in chunks(batches):
            coded = c.encode_many([b.decode() for b in bodies])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(coded, pa.list_(pa.int32())),
                 pa.array([c.decode(x) for x in coded], pa.string())], ["doc_id", "ids", "decoded"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode`, but ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: the digests are taken where the ids are made."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for ids, bodies in chunks(batches):
            decimal, counts, own, back = c.decimal.__getitem__, [], [], []
            for packed in c.pack_many([b.decode() for b in bodies]):
                coded = c.unpack(packed)
                counts.append(len(coded))
                own.append(hashlib.sha256(",".join(map(decimal, coded)).encode()).hexdigest())
                back.append(hashlib.sha256(c.decode(coded).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(own), pa.array(back)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
