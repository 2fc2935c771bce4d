"""Exact, near and line deduplication against brute force, with edge cases."""
import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedyard.llm import exact_dedup, line_dedup, near_dedup
from feedyard.llm.components import components


def exact_truth(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return groups


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, frame, tmp_path, weak):
    rows = [(7, "a  b"), (3, "a b"), (9, "a\n\tb"), (1, None), (2, ""), (None, "a b"), (None, "alone"), (4, "other"), (4, "other"), (5, "é x"), (6, "é x"), (8, "z" * 50000)]
    path = str(tmp_path / "docs")
    frame(rows).repartition(3).write.parquet(path)
    digest = (lambda c: F.substring(exact_dedup.sha256(F.lower(c)), 1, 0)) if weak else exact_dedup.sha256  # every text has one digest
    got = exact_dedup.exact_dedup(spark, path, digest=digest).collect()
    truth = exact_truth(rows)
    assert len(got) == len(rows)
    for text, ids in truth.items():
        mine = [r for r in got if r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()]
        low = min((i for i in ids if i is not None), default=None)
        assert {r["keep_id"] for r in mine} == {low} and {r["group_size"] for r in mine} == {len(ids)}
        assert sum(r["kept"] for r in mine) == 1


def test_exact_state_goes_on(spark, frame, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    frame([(5, "one"), (6, "two")]).write.parquet(path)
    exact_dedup.update_state(spark, path, state)
    frame([(1, "one"), (9, "three")]).write.mode("append").parquet(path)
    exact_dedup.update_state(spark, path, state)
    got = sorted((r["keeper"]["id"], r["n"]) for r in exact_dedup.read_state(spark, state).collect())
    assert got == [(1, 2), (6, 1), (9, 1)]


def test_drop_copies_keeps_columns(spark, frame):
    docs = frame([(2, "a b"), (1, "a  b"), (1, "a  b"), (3, None), (4, "")])
    out = exact_dedup.drop_copies(spark, docs)
    assert out.schema.names == docs.schema.names
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "a  b"), (3, None)]
    assert exact_dedup.drop_copies(spark, frame([])).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_truth(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None and (low[r] is None or i < low[r]):
            low[r] = i
    return [(i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows)]


def copies(r, text, n, changes):
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(changes):
            words[r.randrange(len(words))] = f"w{r.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def test_near_components_by_brute_force(frame):
    r = random.Random(5)
    texts = [" ".join(f"t{r.randrange(400)}" for _ in range(r.randint(5, 200))) for _ in range(60)]
    for t in texts[:12]:
        texts += copies(r, t, 6, max(1, len(t.split()) // 40))
    texts += ["", None, "  \n", "Few Words", "few words", "few words more", "A b c D e", "a B c d e", "x " * 30000]
    rows = [(k * 3 % 1009, t) for k, t in enumerate(texts)] + [(None, texts[3]), (4, texts[3]), (4, texts[3])]
    got = near_dedup.near_components(frame(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(x)[:3] for x in got), key=repr) == sorted(near_truth(rows), key=repr)
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in got)
    assert near_dedup.near_components(frame([])).count() == 0


def test_large_group_of_near_copies_and_a_cloud_below_the_limit(frame, monkeypatch):
    """A bucket above the limit is split, and chains are followed, without all pairs of a group."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    r = random.Random(9)
    base = " ".join(f"b{r.randrange(5000)}" for _ in range(150))
    rows = list(enumerate(copies(r, base, 60, 1) + copies(r, base, 60, 6)))
    got = near_dedup.near_components(frame(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(near_truth(rows))
    kept = near_dedup.drop_near_copies(frame(rows))
    assert {x["doc_id"] for x in kept.collect()} == {c for _, _, c in near_truth(rows)}


def test_pruning_bound():
    least = near_dedup.least_matches()
    assert len(least) == near_dedup.HASHES // near_dedup.BATCH and least == sorted(least) and least[-1] < 96


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(205, 200), (203, 205), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 130)} == {100} and {got[k] for k in (200, 203, 205)} == {200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def line_truth(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\t\n\x0b\x0c\r "))
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10 and i is not None:
                seen[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(seen[key(x)]) < 2 or min(seen[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("bits", [1 << 20, 1 << 12])  # the second is full, so everything is suspected
def test_lines_by_brute_force(frame, bits):
    r = random.Random(2)
    pool = [f"Line number {k} of the POOL" for k in range(30)] + ["short", "", "éééééééééé", "ééééééééé", "  padded line here\t", "PADDED line here"]
    rows = [(r.randrange(500), "\n".join(r.choice(pool) for _ in range(r.randint(1, 8)))) for _ in range(150)]
    rows += [(None, pool[0]), (1, None), (2, ""), (3, pool[1]), (3, pool[1]), (3, pool[2] + "\n" + pool[1]), (600, "\n".join(f"own line {k} in this text" for k in range(5000)))]
    got = line_dedup.line_dedup(frame(rows), bits=bits).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(line_truth(rows), key=repr)


def test_no_lines(frame):
    assert line_dedup.line_dedup(frame([])).count() == 0
