from __future__ import annotations

import collections
import math
import random
import re

import numpy as np

from skyledger.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, best=10):
    """Every document scored in full for every item."""
    counted = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in counted for t in c)
    out = collections.Counter()
    for item, text in items:
        scored = []
        for (doc, c), size in zip(counted, sizes):
            score = 0
            for t in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * size * n // total)))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out.update((item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(scored)[:best]))
    return out


def tables(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string"),
            spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string"))


def found(spark, docs, items, **settings):
    d, q = tables(spark, docs, items)
    rows = ranked.search(d, q, ranked.Settings(**settings)).collect()
    return collections.Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows)


def corpus(seed=2, n=600):
    pick = random.Random(seed)
    vocabulary = [f"w{int(1.35 ** i) % 997}é{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(w.upper() if pick.random() < 0.1 else w for w in pick.choices(vocabulary, weights, k=pick.randrange(1, 60))))
            for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(40)]  # ties
    docs += [(5_000, None), (5_001, ""), (5_002, " ,;- "), (None, docs[0][1]), (5_003, "only_here only here!"), (3, docs[3][1])]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.randrange(1, 12)))) for i in range(20)]
    items += [(100, None), (101, ""), (102, "unseen words"), (103, "only-HERE"), (None, docs[5][1]), (104, docs[0][1]), (104, docs[1][1])]
    return docs, items


def test_ranks_are_those_of_a_full_scan(spark):
    docs, items = corpus()
    expected = plain(docs, items)
    assert found(spark, docs, items) == expected
    # many small segments, several blocks of queries, lists read a posting at a time
    assert found(spark, docs, items, segment_bytes=2_000, query_bytes=200, stretch_bytes=300, first_read=1) == expected
    assert found(spark, docs, items, best=3) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(n=10)
    assert not found(spark, [], items) and not found(spark, docs, []) and not found(spark, [(1, None)], items)


def test_reading_stops_before_the_end_of_the_lists():
    n = 20_000
    rng = np.random.default_rng(1)
    doc = np.concatenate([rng.permutation(n)[: n // 2] for _ in range(3)])
    term = np.repeat(np.arange(3), n // 2)
    times = rng.zipf(1.5, len(doc)).clip(max=10_000)
    segment = ranked.Segment(np.arange(n), np.full(n, 50), term, doc, times, n, 50 * n)
    query = ranked.Query(0, np.arange(3), np.array([900, 700, 500]))
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop - key.start)
            return np.asarray(super().__getitem__(key))

    segment.doc, whole = segment.doc.view(Watched), segment.doc
    places, scores = ranked.no_random_access(segment, query, ranked.Settings())
    assert sum(read) < len(doc) / 2
    full = np.zeros(n, np.int64)
    np.add.at(full, whole, segment.impact * np.array([900, 700, 500])[segment.term])
    order = np.lexsort((np.arange(n), -full))[:10]
    assert places.tolist() == order.tolist() and scores.tolist() == full[order].tolist()


def test_a_long_text_is_cut_between_terms():
    data = np.frombuffer(("ab cd " * 500 + "x" * 3_000 + " end").encode(), np.uint8)
    at = np.array([0, 10, 10, len(data)])
    cuts = list(ranked.stretches(data, at, 97))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    whole = ranked.terms(data, at)[0].to_pylist()
    parts = [t for a, b in cuts for t in ranked.terms(data[a:b], np.clip(at, a, b) - a)[0].to_pylist()]
    assert parts == whole
