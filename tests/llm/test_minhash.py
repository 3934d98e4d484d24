from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import minhash, texts
from skyledger.llm.components import components


def brute_sets(rows, size=5):
    out = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        out[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


def brute_components(rows, percent=85):
    sets = brute_sets(rows)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in ids}


def varied_docs(seed=5, groups=12):
    pick = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for g in range(groups):
        base = [pick.choice(vocab) for _ in range(pick.choice([3, 5, 8, 120, 300]))]
        for _ in range(pick.choice([1, 2, 5, 40])):
            own = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 4, 8]) if len(own) > 50 else 0):
                own[pick.randrange(len(own))] = pick.choice(vocab)
            rows.append((n, (" \n".join(own)).upper() if n % 3 == 0 else "\t ".join(own)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one"), (n + 4, "ONE "), (n + 5, "x" * 200_000 + " end")]
    pick.shuffle(rows)
    return rows


def test_shingles_match_plain_python():
    rows = varied_docs()
    hashes, at = texts.shingle_sets(pa.array([t for _, t in rows], pa.string()), 5)
    assert [b - a for a, b in zip(at[:-1], at[1:])] == [len(s) for s in brute_sets(rows).values()]
    one, two = texts.shingle_sets(pa.array(["A b c d e", "a B  c d\ne"]), 5)
    assert one[0] == one[1] and list(two) == [0, 1, 2]


def test_registers_estimate_similarity_and_merge():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[500:])
    both = np.sort(pool)
    regs = minhash.sketch(np.concatenate((a, b, both)), np.array([0, 1000, 2000, 3500]), 512)
    assert abs((regs[0] == regs[1]).mean() - 1 / 3) < 0.08
    assert (minhash.merge_sketches(regs[0], regs[1]) == regs[2]).all()
    few = minhash.sketch(np.array([7], np.uint64), np.array([0, 1, 1]), 64)
    assert (few[0] > 0).all() and (few[1] == 0).all()


def test_likelihood_rules_out_only_what_is_far_below():
    n = np.array([1000, 1000, 500])
    above, below = np.array([5, 60, 10]), np.array([5, 60, 10])
    equal = 156 - above - below
    out = minhash.ruled_out(n, np.array([1000, 1000, 1000]), above, below, equal, 85, 18.0)
    assert out.tolist() == [False, True, True]


@pytest.mark.parametrize("tile", [512, 7])
def test_components_match_brute_force(spark, tile):
    rows = varied_docs()
    sets, want = brute_components(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component string")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, minhash.Settings(tile=tile)).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("2", 2, True), ("None", None, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    left = minhash.keep_one(docs.withColumn("text2", docs.text)).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "2", "None"]


def test_connected_components(spark):
    pick = random.Random(2)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(5, None)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in top}
