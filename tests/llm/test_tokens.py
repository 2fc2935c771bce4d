"""BPE and token files against the library, edge cases and random texts."""
import hashlib
import random
import sys
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from feedyard.llm import bpe, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "  \n\t x", "<|endoftext|>hi<|endoftext|>", "x" * 5000, "ab" * 3000, "it's I'll '", "\x1c\x1d a\x85b c", "日本語テキスト١٢٣ ½²x", "😀😀 😀", "\x00\x01", "  a  b   "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.BytePairCodec(PATH)


def test_encodes_and_decodes_as_the_library(codec, library):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice("ab 'st\n\té١½😀.xyz09-") for _ in range(r.randint(1, 80))) for _ in range(400)]
    for text, ids in zip(texts, codec.encode_many(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:40]
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_words_are_kept_in_few_bytes(codec):
    """Many distinct words, then long ones: what a worker keeps is small per word and counted by bytes."""
    codec.encode_many(["warm"])
    before, text = len(codec.known), " ".join(f"{i * 7919:x}q{i:x}" for i in range(30_000))
    tracemalloc.start()
    try:
        codec.encode_many([text])
        assert tracemalloc.get_traced_memory()[0] / (len(codec.known) - before) < 130
    finally:
        tracemalloc.stop()
    r = random.Random(5)
    for _ in range(4):
        codec.encode_many(["".join(r.choices("abcdefghij", k=40)) * 40 for _ in range(40)])
        assert sum(sys.getsizeof(w) + sys.getsizeof(x) for w, x in codec.known.items()) <= codec.held


def test_store_starts_anew_beyond_its_bytes(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "BYTES_KEPT", 20_000)
    for n in range(6):
        text = " ".join(f"w{n}x{i}" for i in range(150)) + " " + "z" * (1000 + n)
        assert codec.encode_many([text])[0] == library.encode(text, add_special_tokens=False).ids
        assert codec.held < 60_000 or n == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(codec, text):
    assert codec.decode(codec.encode_many([text])[0]) == text


@given(st.lists(st.text("abeht os", min_size=1, max_size=24), min_size=5, max_size=40))
@settings(max_examples=40, deadline=None)
def test_many_trees_equal_one_tree(codec, words):
    data = [w.encode() for w in words]
    assert [x.tolist() for x in codec.merge(data)] == [codec._merge_one(w) if len(w) else [] for w in data]


def test_rows_of_all_kinds(frame, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (3, "other"), (4, "long words " * 4000)]
    got = bpe.digests(frame(rows), PATH).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    full = bpe.encode(frame(rows), PATH).collect()
    assert sorted((r["decoded"] for r in full)) == sorted(t or "" for _, t in rows)
    assert bpe.digests(frame([]), PATH).count() == 0


def test_files_read_back(frame, library, tmp_path):
    rows = [(5, "five words are in here"), (1, None), (2, ""), (None, "no id"), (9, "x " * 9000), (3, "same"), (3, "same")]
    manifest = token_files.write_shards(frame(rows), PATH, 2, str(tmp_path / "out"))
    got = sorted(map(tuple, token_files.read_shards(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 3, 3, 5, 9]
    at = 0
    for i, start, n, crc in got:
        ids = library.encode(dict(rows)[i] or "", add_special_tokens=False).ids + [2]
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert token_files.token_files(frame([]), PATH, 2, str(tmp_path / "none")).count() == 0


def test_reader_takes_only_the_frame_and_sees_damage(spark, frame, library, tmp_path):
    manifest = token_files.write_shards(frame([(1, "alpha beta"), (2, "gamma delta epsilon"), (3, "zeta")]).coalesce(1), PATH, 2, str(tmp_path / "one")).collect()
    for row in manifest:
        fs, path = token_files.file_system(row["path"])
        with fs.open_input_file(path) as source:
            shard = token_files.ShardReader(source)
            reads = []
            inner = shard._at
            shard._at = lambda offset, size: reads.append(size) or inner(offset, size)
            last = len(shard) - 1
            shard.tokens(last)
            assert len(reads) == 1 and reads[0] == shard.begin[last + 2] - shard.begin[last + 1]
        data = bytearray(open(path, "rb").read())
        data[int(shard.begin[1]) + 8] ^= 255
        bad = tmp_path / "damaged.tok"
        bad.write_bytes(data)
        with fs.open_input_file(str(bad)) as source, pytest.raises(Exception):
            token_files.ShardReader(source).tokens(0)
    where = spark.createDataFrame([(manifest[0]["shard"], 0)], "shard int, position int")
    assert token_files.fetch(spark.createDataFrame(manifest, "shard int, path string, n_docs bigint, n_tokens bigint, start bigint"), where).count() == 1
