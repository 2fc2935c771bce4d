"""Curriculum, periodic runs and Merkle manifest against brute force, with edge cases."""
import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedyard.llm import curriculum, merkle, periodic_runs
from feedyard.llm.common import running_sum

EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint, name string, tree string, place string, size string, node string, n string"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents from (doc_id, source, text), with other columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), "x", "y", "z", "a", "b", "c") for i, s, t in rows], EDGE)
    return make


def some_rows(n, seed=0):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "a", "a", "b", "c", "é", "Z", None]), " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 1, 5, 40])))) for k in range(n)]
    return rows + [(None, "a", "null id"), (None, "a", "null id"), (3, "b", "again"), (3, "b", "again"), (7, "only", "one two"), (8, "hollow", None), (9, "hollow", ""), (10, "b", "z " * 20000)]


def test_running_sum_spans_tasks(spark):
    rows = spark.range(0, 5000, 1, 16).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).cast("bigint").alias("g"), (F.col("id") * 7919 % 5003).alias("v"), F.col("id").alias("d"))
    got = running_sum(rows.repartition(9), "g", [F.col("v")], {"v": "before"}).orderBy("g", "v").collect()
    place, total = defaultdict(int), defaultdict(int)
    for r in got:
        assert (r["place"], r["before"]) == (place[r["g"]], total[r["g"]])
        place[r["g"]] += 1
        total[r["g"]] += r["v"]
    assert len(got) == 5000


def filled(sizes, share=1.5, repeats=2.0, weights=(3, 1, 2)):
    """Targets by resharing what stands above a limit until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(repeats * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: repeats * sizes[s] if s in full else weight[s] * left / total for s in names}
        over = {s for s in names if s not in full and target[s] > repeats * sizes[s]}
        if not over:
            return target
        full |= over


def test_curriculum_against_brute_force(spark, docs):
    rows = some_rows(300)
    order = curriculum.training_order(docs(rows).repartition(5)).collect()
    got = curriculum.mix(docs(rows).repartition(3)).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    target = filled(sizes)
    assert sorted((i if i is not None else -1, len((t or "").split()), sizes[s]) for i, s, t in rows) == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["source_size"]) for r in got)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    for number, name in enumerate(names):
        mine = [r for r in order if r["source_no"] == number]
        assert mine[0]["target"] == pytest.approx(target[name], rel=1e-12)
        assert sum(r["words"] for r in mine) == math.floor(target[name] + 1e-9)
        # at a visit's position the integral of the schedule stands at the words of the source so far
        knots = curriculum.SCHEDULES[number % 3]
        done = 0
        for r in sorted((r for r in mine if r["visit"] is not None), key=lambda r: r["position"]):
            t = np.linspace(0, r["position"], 20001)
            w = np.interp(t, *zip(*knots))
            reached = ((w[1:] + w[:-1]) / 2 * np.diff(t)).sum() / curriculum.area(knots) * r["target"]
            assert reached == pytest.approx(done + r["words"] / 2, abs=1e-3 * target[name] + 1e-6)
            done += r["words"]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(str, got)) == sorted(map(str, curriculum.mix(docs(rows)).collect()))  # however the rows are dealt
    met = sorted((r for r in order if r["visit"] is not None), key=lambda r: r["start"])
    assert [r["position"] for r in met] == sorted(r["position"] for r in met)
    assert [r["start"] for r in met] == [0, *np.cumsum([r["words"] for r in met])[:-1].tolist()]


def test_curriculum_follows_the_schedules(spark, docs):
    rows = [(k, s, "w " * 20) for s, m in (("a", 4000), ("b", 4000), ("c", 4000)) for k in range(m)]
    order = curriculum.training_order(docs(rows), share=0.3).filter("visit is not null").select("source_no", "position").toPandas()
    for t in (0.1, 0.5, 0.9):
        near = order[(order.position - t).abs() < 0.05].source_no.value_counts(normalize=True)
        w = [np.interp(t, *zip(*s)) for s in curriculum.SCHEDULES]
        for k in range(3):
            assert near[k] == pytest.approx(w[k] / sum(w), abs=0.04)


def test_curriculum_of_nothing(spark, docs):
    assert curriculum.mix(docs([])).count() == 0
    hollow = curriculum.mix(docs([(1, "a", None), (2, None, " ")])).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"], r["first_position"]) for r in hollow) == [(1, 0, 0, None), (2, 0, 0, None)]
    assert curriculum.word_count("a\u00a0b\u2003c \x1c d".encode()) == 3


def runs_by_lag(x, least=24):
    out = {}
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i + q < len(x):
            s = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 3 * q):
                out[s, i - s + q] = min(q, out.get((s, i - s + q), q))
            i += 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    k = rng.choice([1, 2, 3, 5, 50])
    d = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
    while rng.random() < 0.7:
        u = [rng.randrange(k) for _ in range(rng.randint(1, 70))] * rng.choice([1, 1, 2, 3])
        d += (u * 6)[:int(len(u) * rng.uniform(1, 5))] + [rng.randrange(k) for _ in range(rng.randint(0, 20))]
    return d


def test_runs_against_lags():
    rng, met = random.Random(5), 0
    for _ in range(120):
        group = [np.array(periodic_words(rng), np.int64) for _ in range(rng.randint(0, 6))]
        for x, runs in zip(group, periodic_runs.find_runs(group)):
            assert runs == runs_by_lag(x.tolist())
            met += len(runs)
    assert met > 300
    a, b = "0", "01"
    while len(b) < 1500:  # overlapping runs of many periods
        a, b = b, b + a
    assert periodic_runs.find_runs([np.array(list(map(int, b)))])[0] == runs_by_lag(b)


def test_every_long_period_has_a_scale():
    covered = set()
    for low, w, v in periodic_runs.scales(3 * 10**5):
        covered |= set(range(low + 1, w + 1))
        assert v >= 1 and all(v <= 2 * q - w + 1 for q in range(low + 1, w + 1))
    assert covered >= set(range(periodic_runs.SHORT + 1, 10**5 + 1))


def test_periodic_runs_of_documents(spark, docs):
    rng = random.Random(9)
    texts = [" ".join(f"w{k}" for k in periodic_words(rng)) for _ in range(40)]
    texts += [None, "", " \n\t", "a " * 23, "a " * 24, "a\n" * 30 + "b", "x y é\u00a0z " * 9, "long " * 300_000, "a " * 24, "a " * 24]
    rows = [(k if k % 9 else None, "s", t) for k, t in enumerate(texts)]
    got = periodic_runs.periodic_runs(docs(rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, t in rows:
        words = (t or "").encode().split()
        runs = [(0, len(words), 1)] if len(words) > 10**5 else runs_by_lag(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((i, len(words), runs, best, b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["strongest"] and tuple(r["strongest"]), r["collapsed_text"])) for r in got)
    assert periodic_runs.periodic_runs(docs([])).count() == 0


def test_planted_runs(spark, docs):
    rows = [(k, "s", " ".join(f"t{j}" for j in range(k % 57))) for k in range(400)] + [(None, "s", "a b"), (5, "s", None)]
    got = {(r["doc_id"], r["text"]) for r in periodic_runs.with_planted_runs(docs(rows)).collect()}
    for i, _, t in rows:
        words, h = (t or "").split(), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
        assert (i, t or "") in got


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k:k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def proof_of(levels, k):
    out = []
    for nodes in levels[:-1]:
        begin = k - k % 3
        out.append(("".join(nodes[begin:k]), "".join(nodes[k + 1:begin + 3])))
        k //= 3
    return out


def manifest_truth(rows):
    def leaf(i, s, t, n):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, None, n, t)))

    by = defaultdict(list)
    for i, s, t in rows:
        n = None if t is None else len(t)
        back = t.replace("\n", "") if t and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t
        by[s].append(((i is not None, i or 0, leaf(i, s, t, n)), i, leaf(i, s, back, n)))
    trees = {s: sorted(v) for s, v in by.items()}
    levels = {s: tree_of([x[0][2] for x in v]) for s, v in trees.items()}
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree_of([levels[s][-1][0] for s in names])
    for j, s in enumerate(names):
        for k, ((_, _, mine), i, back) in enumerate(trees[s]):
            proof = proof_of(levels[s], k) + proof_of(top, j)
            for left, right in proof:
                back = h(left + back + right)
            yield i, mine, levels[s][-1][0], top[-1][0], h("".join(a + b for a, b in proof)), back, back == top[-1][0]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_against_brute_force(spark, docs, levels):
    """Superblocks of 3 and 9 nodes make several rounds of the exchange."""
    rows = some_rows(200, 3) + [(k, "lines", f"one\ntwo {k}") for k in range(40)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    received = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.manifest(docs(rows).repartition(4), received, levels=levels).collect()
    assert sorted(map(str, manifest_truth(rows))) == sorted(str(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in got)
    assert {r["verified"] for r in got} == {True, False}
    assert all(merkle.fold(r["leaf"], r["path"]) == r["root"] for r in got)


def test_manifest_of_little(spark, docs):
    assert merkle.manifest(docs([])).count() == 0
    one = merkle.manifest(docs([(1, None, None)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] == h("1:1----") and one["path"] == "" and one["verified"]
