from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from skyledger.llm import decontam, langid, lm, packing, sharding, texts, toxicity

EDGE = [None, "", " \n\t", "...", "a b c", "é" * 30_000, "a b c"]
DOCS = "doc_id long, text string, score string, shard string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS)


def prose(pick, vocab, n):
    return " ".join(pick.choice(vocab) for _ in range(n)) + "."


# --- toxicity

def labelled(seed=1, n=400):
    pick = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("lo", "mi", "ta", "re", "du") for b in ("n", "ster", "ko", "ma")]
    rows = []
    for i in range(n):
        parts = [prose(pick, vocab, 8) for _ in range(6)]
        bad = i % 4 == 0
        if bad:
            parts[pick.randrange(6)] += " you grubble" + pick.choice(["s", "d", "st", ""]) + " now."
        rows.append((i, " ".join(parts), int(bad)))
    return rows


def test_toxicity_learns_from_documents_and_points_at_sentences(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 5], "doc_id long, label int")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0]
    assert sum(held) / len(held) > 0.97
    found = toxicity.locate(docs, model).collect()
    assert found and all("grubble" in r["text"] for r in found)
    text = dict(r[:2] for r in rows)
    assert all(text[r["doc_id"]].encode()[r["start"]:r["start"] + r["bytes"]].decode() == r["text"] for r in found)
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s < 0.5}


def plain_sentences(text, weights, bias):
    """Each sentence of a text and its score, by loops over its words and their beginnings."""
    found = []
    for sentence in re.findall(rb"[^\n!.?]*[\n!.?]|[^\n!.?]+", (text or "").encode()):
        z = bias
        for word in re.findall(rb"[A-Za-z\x80-\xff]+", sentence):
            for k in toxicity.PREFIXES:
                start = np.frombuffer(word[:k].lower(), np.uint8)
                number = texts.hash_spans(start, np.array([0]), np.array([len(start)])) + np.uint64(k)
                z += weights.get(int(number[0]), 0.0)
        found.append((sentence, 1 / (1 + math.exp(-z))))
    return found


def test_toxicity_scores_are_the_noisy_or_of_plain_sentences(spark):
    rows = labelled(3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    weights = dict(zip(map(int, model.words), map(float, model.weights)))
    assert any(weights.values())
    pick = random.Random(8)
    vocab = ["you", "GRUBBLES", "grubblé", "gru", "loster", "a", "é", "7", "grubble", "now", "\n", "!", "..", "?", " "]
    tried = [*EDGE, "grubbled", "?grubbles!", *(pick.choice(["", " "]).join(pick.choices(vocab, k=pick.randint(1, 30))) for _ in range(300))]
    tried += [t for _, t, _ in rows[:50]] + tried[5:9]
    got = {r["doc_id"]: r for r in toxicity.score(docs_of(spark, tried), model).collect()}
    located = {(r["doc_id"], r["sentence"]): (r["text"], r["score"]) for r in toxicity.locate(docs_of(spark, tried), model, 0.3).collect()}
    expected = {}
    for i, text in enumerate(tried):
        plain = plain_sentences(text, weights, model.bias)
        assert got[i]["score"] == pytest.approx(1 - math.prod(1 - p for _, p in plain), abs=1e-9)
        assert got[i]["offending"] == sum(p >= 0.5 for _, p in plain)
        expected |= {(i, n): (t.decode(), pytest.approx(p)) for n, (t, p) in enumerate(plain) if p >= 0.3}
    assert expected and located == expected


def test_toxicity_edges(spark):
    model = toxicity.fit(toxicity.labelled_sample(docs_of(spark, EDGE), spark.createDataFrame([(1, None)], "doc_id long, label int")))
    rows = toxicity.score(docs_of(spark, EDGE), model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] < 0.5 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (0, 1)} == {0.0}
    assert toxicity.score(docs_of(spark, EDGE).limit(0), model).count() == 0


# --- language

def test_language(spark):
    pick = random.Random(4)
    words = {"xx": ["tion", "ment", "oux", "ette"], "yy": ["schaft", "keit", "ung", "heit"], "zz": ["ando", "cion", "mente", "ez"]}
    rows = [(i, lang, " ".join("".join(pick.choices(words[lang], k=2)) for _ in range(60)))
            for i, lang in enumerate(["xx", "yy", "zz"] * 60)]
    docs = spark.createDataFrame([(i, t, l) for i, l, t in rows], "doc_id long, text string, lang string")
    learned = langid.fit(docs.where("doc_id % 3 != 1 OR doc_id < 60"))
    got = {r["doc_id"]: r for r in langid.classify(docs, learned).collect()}
    assert all(got[i]["lang_pred"] == l and not got[i]["rejected"] and 0.5 < got[i]["score"] <= 1 for i, l, _ in rows)
    edge = langid.classify(docs_of(spark, EDGE), learned).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in edge[:4]] == ["und"] * 4 and all(r["rejected"] for r in edge[:4])
    assert langid.keep_clear(docs, learned).count() == len(rows)
    assert {r["lang_pred"] for r in langid.classify(docs, {}).collect()} == {"und"}


def test_language_rejects_what_is_in_none_or_in_two(spark):
    pick = random.Random(14)
    words = {"xx": ["tion", "ment", "oux", "ette"], "yy": ["schaft", "keit", "ung", "heit"], "zz": ["ando", "cion", "mente", "ez"]}
    said = lambda lang, n: " ".join("".join(pick.choices(words[lang], k=2)) for _ in range(n))
    docs = spark.createDataFrame([(i, said(lang, 60), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 60)],
                                 "doc_id long, text string, lang string")
    learned = langid.fit(docs)
    one = [said(lang, n) for lang in words for n in (8, 12, 60, 800)]
    two = [said("xx", n) + " " + said("yy", n) for n in (150, 400, 1500)] + [said("zz", 900) + " " + said("xx", 800)]
    none = [" ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randrange(2, 9))) for _ in range(200)) for _ in range(10)]
    got = [r["rejected"] for r in langid.classify(docs_of(spark, one + two + none), learned).orderBy("doc_id").collect()]
    assert got == [False] * len(one) + [True] * (len(two) + len(none))
    assert langid.keep_clear(docs_of(spark, one + two + none), learned).count() == len(one)


def test_language_is_that_of_the_smallest_compressed_size(spark):
    """Against zstandard used plainly, a stretch at a time."""
    pick = random.Random(15)
    words = {"xx": ["tion", "ment", "oux"], "yy": ["tion", "keit", "ung"]}
    rows = [(i, " ".join("".join(pick.choices(words[lang], k=2)) for _ in range(pick.randrange(1, 400))), lang)
            for i, lang in enumerate(["xx", "yy"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned, s = langid.fit(docs), langid.Settings()
    got = {r["doc_id"]: r["lang_pred"] for r in langid.classify(docs, learned).collect()}
    params = zstandard.ZstdCompressionParameters.from_level(1, strategy=zstandard.STRATEGY_LAZY2, min_match=3, write_content_size=0)
    for i, text, _ in rows:
        raw, sums = langid.letters(text), {}
        n = -(-len(raw) // s.stretch_bytes)
        width = -(-len(raw) // n)
        for lang, own in learned.items():
            plain = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                             compression_params=params)
            sums[lang] = sum(len(plain.compress(own[-s.lead_bytes :] + b" " + raw[j * width : (j + 1) * width])) for j in range(n))
        assert got[i] == min(sorted(sums), key=sums.get)


# --- packing

def test_word_cache_gives_the_tokenizers_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, whole = packing.WordEncoder(path), Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    samples = ["Hello, WORLD!! it's we'll 'tis don't...", "Ça déjà-vu ÑANDÚ größe ÀÉ×÷ ﬁ İstanbul ΣΑΣ", "a b c　d é",
               "<|endoftext|> x<|startoftext|>", "日本語 テスト 123 4.5%", "", " \n", "mixed123abc _under_score_ [x]{y}", "🙂🙂 a🙂b"]
    for text in samples:
        assert own.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("open_bins", [3, 1024])
def test_bins_hold_what_fits_and_take_the_tightest(open_bins):
    pick = random.Random(9)
    bins, used, free = packing.Bins(100, open_bins), collections.defaultdict(int), {}
    for _ in range(3000):
        n = pick.randint(1, 100)
        fits = [f for f in free.values() if f >= n]
        number, offset = bins.put(n)
        assert offset == used[number] and offset + n <= 100
        if fits:
            assert free.pop(number) == min(fits)
        used[number] += n
        if used[number] < 100:
            if len(free) == open_bins:
                closed = min(free.values())
                free.pop(next(b for b in reversed(list(free)) if free[b] == closed))
            free[number] = 100 - used[number]
        assert sorted(free.values()) == sorted(f for f, held in enumerate(bins.bins) for _ in held)


def test_packing_places_every_piece(spark):
    pick = random.Random(2)
    texts = [prose(pick, ["alpha", "beta", "gamma"], n) for n in (0, 1, 50, 700, 3000)] + EDGE
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(docs_of(spark, texts), path, 512).collect()
    whole = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == [(k, len(ids[k:k + 512])) for k in range(0, len(ids), 512)]
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(np.array(ids[k:k + 512], "<u4").tobytes()) for k in range(0, len(ids), 512)]
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 512
    assert packing.pack_documents(docs_of(spark, EDGE).limit(0), path).count() == 0


# --- language model

def test_lm_base_is_exact_and_pairs_help(spark):
    pick = random.Random(6)
    vocab = [f"w{i}" for i in range(60)]
    texts = [prose(pick, vocab, pick.randint(1, 40)) + " The Quick brown fox" * pick.randint(0, 3) for _ in range(120)] + EDGE
    docs = docs_of(spark, texts)
    model = lm.train(docs.where("doc_id % 3 != 0"))
    got = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    tokens = lambda t: [*(t or "").encode().lower().split(), "<end>"]
    counts = collections.Counter(w for i, t in enumerate(texts) if i % 3 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(tokens(t)) and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in tokens(t))
        assert math.isclose(got[i]["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), rel_tol=1e-9)
        assert got[i]["score"] < 0
    held = [i for i in range(120) if i % 3 == 0 and "fox" in texts[i]]
    assert sum(got[i]["score"] > got[i]["base_score"] for i in held) > 0.9 * len(held)
    assert lm.score(docs.limit(0), model).count() == 0

    # the filter in many bounded parts, over repeated rows too, gives what one part gives
    twice = docs.unionByName(docs)
    parts = lm.Settings(part_bytes=1)
    assert len(list(lm.filter_parts(model, parts))) == model.buckets
    many = lm.score(twice, model, parts).collect()
    assert len(many) == 2 * len(texts)
    for r in many:
        assert r["score"] == pytest.approx(got[r["doc_id"]]["score"], abs=1e-6)
        assert r["base_score"] == pytest.approx(got[r["doc_id"]]["base_score"], abs=1e-6)
        assert (r["n_tokens"], r["n_known"]) == (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["n_known"])
    assert lm.score(docs, lm.train(docs.limit(0))).count() == len(texts)


def test_lm_scores_are_those_of_exact_pair_counts(spark):
    pick = random.Random(12)
    vocab = [f"v{i}" for i in range(3000)]
    texts = [" ".join(pick.choice(vocab) for _ in range(60)) for _ in range(150)]
    docs, s = docs_of(spark, texts), lm.Settings()
    model = lm.train(docs.where("doc_id % 3 != 0"))
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()}
    single, both, mass = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        if i % 3:
            words = [*t.split(), "<end>"]
            single.update(words)
            both.update(zip(["<start>", *words], words))
    single["<start>"] = single["<end>"]
    gain = {k: float(lm.typical(lm.level(np.array([c]), 1, s.base), 1, s.base)[0]) - s.discount for k, c in both.items()}
    for (before, _), g in gain.items():
        mass[before] += g
    n, v = model.tokens, model.distinct
    unseen = 0
    for i, t in enumerate(texts):
        words, want = [*t.split(), "<end>"], 0.0
        for before, word in zip(["<start>", *words], words):
            p, c = (single[word] + 1) / (n + v + 1), single[before]
            kept = min(mass[before] / c, 0.999) if c else 0.0
            want += math.log10(min(gain.get((before, word), 0.0) / c, kept) + (1 - kept) * p if c else p)
            unseen += (before, word) not in gain
        assert got[i] == pytest.approx(want, abs=0.02 * len(words))
    assert unseen > 2000
    # every word after every word: next to none that was not seen, and what they get is small
    (own,) = lm.filter_parts(model)
    hashes, _ = lm.tokens(pa.array([" ".join(vocab)]))
    hashes = hashes[:-1]  # without the closing token
    asked = ((hashes[:300, None] >> np.uint64(32)) << np.uint64(32) | hashes[None, :] >> np.uint64(32)).ravel()
    seen = sum((a, b) in gain for a in vocab[:300] for b in vocab)
    assert 0 <= (own.levels(asked) > 0).sum() - seen < 2 * model.rate * len(asked) < 100
    assert model.rate * v * (1 - s.discount) <= s.false_mass
    assert lm.hashes_for(1_000_000_000, s) > lm.hashes_for(1_000_000, s) > 20


def test_lm_frequent_words_and_many_parts(spark):
    """Words of very different counts: fewer hashes after frequent ones, several parts, scores of exact counts."""
    pick = random.Random(21)
    vocab = [f"z{i}" for i in range(4000)]
    weights = [1 / (i + 1) for i in range(4000)]
    texts = [" ".join(pick.choices(vocab, weights, k=120)) for _ in range(300)]
    docs, s = docs_of(spark, texts), lm.Settings(part_bytes=20_000)
    model = lm.train(docs.where("doc_id % 3 != 0"))
    assert len(list(lm.filter_parts(model, s))) > 2 and len(model.often.halves) > 20
    assert model.often.hashes.min() < model.hashes - 5
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, model, s).collect()}
    single, both, mass = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        if i % 3:
            words = [*t.split(), "<end>"]
            single.update(words)
            both.update(zip(["<start>", *words], words))
    single["<start>"] = single["<end>"]
    gain = {k: float(lm.typical(lm.level(np.array([c]), 1, s.base), 1, s.base)[0]) - s.discount for k, c in both.items()}
    for (before, _), g in gain.items():
        mass[before] += g
    n, v, off, total = model.tokens, model.distinct, 0.0, 0
    for i, t in enumerate(texts):
        words, want = [*t.split(), "<end>"], 0.0
        for before, word in zip(["<start>", *words], words):
            p, c = (single[word] + 1) / (n + v + 1), single[before]
            kept = min(mass[before] / c, 0.999) if c else 0.0
            want += math.log10(min(gain.get((before, word), 0.0) / c, kept) + (1 - kept) * p if c else p)
        if i % 3 == 0:
            off, total = off + got[i] - want, total + len(words)
        assert got[i] == pytest.approx(want, abs=0.03 * len(words))
    assert abs(off / total) < 0.01


def test_bloom_levels_never_fall_short():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    levels = rng.integers(1, 9, 4000)
    bucket = lm.pair_bucket(keys, 4)
    segments = np.stack([np.frombuffer(lm.Filter.segment(keys[bucket == b], levels[bucket == b], 4, 8192), np.uint8) for b in range(4)])
    found = lm.Filter(segments, 4).levels(keys)
    assert (found >= levels).all() and (found == levels).mean() > 0.9
    assert lm.Filter(segments, 4).levels(rng.integers(0, 2**63, 4000, dtype=np.uint64)).mean() < 0.2


# --- decontamination

def brute_edits(pattern: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passages_match_brute_force(spark):
    pick = random.Random(8)
    vocab = ["".join(pick.choices("abcdeit", k=pick.randint(2, 7))) for _ in range(300)]
    items = [(i, prose(pick, vocab, n)) for i, n in enumerate([9, 30, 40, 60])] + [(7, None), (8, "short")]
    texts, s = [], decontam.Settings()
    for k in range(60):
        body = prose(pick, vocab, 40)
        if k % 2:
            passage = items[k % 4][1]
            chars = list(passage)
            for _ in range(pick.choice([0, 0, 2, 5, 9, 30])):
                at = pick.randrange(len(chars))
                chars[at:at + 1] = pick.choice([[], ["q"], [chars[at], "z"]])
            body += "\n " + "".join(chars).upper().replace(" ", "  ") + " " + prose(pick, vocab, 20)
        texts.append(body)
    texts += EDGE
    docs = docs_of(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = decontam.Windows(items, s)
    norm = lambda t: " ".join((t or "").encode().lower().decode("latin-1").split()).encode("latin-1")
    want = {(d, windows.owner[w]) for d, t in enumerate(texts) if len(t or "") < 5000 for w in range(len(windows.owner))
            if brute_edits(windows.chars[w].tobytes(), norm(t)) <= windows.edits[w]}
    rows = decontam.find_passages(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want) > 15
    in_passes = decontam.find_passages(docs, benchmark, decontam.Settings(pass_bytes=150)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in in_passes} == want
    clean = {r["doc_id"] for r in decontam.without_passages(docs, benchmark).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in want}
    assert decontam.find_passages(docs, benchmark.limit(0)).count() == 0


def brute_windows(item: bytes, size: int, text: bytes) -> np.ndarray:
    """Least edits of the window at each byte of an item against any part of a text."""
    every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(item, np.uint8), size)
    chars, slope = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    row = np.zeros((len(every), len(text) + 1), np.int64)
    for i in range(size):
        new = row + 1
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (every[:, i : i + 1] != chars))
        row = np.minimum.accumulate(new - slope, axis=1) + slope
    return row.min(axis=1)


def test_excerpts_at_any_place_are_passages(spark):
    pick = random.Random(21)
    vocab = ["".join(pick.choices("abcdeghiklmnorstu", k=pick.randint(2, 8))) for _ in range(400)]
    items = [(i, prose(pick, vocab, 44)) for i in range(3)]
    texts = []
    for k in range(45):
        source = items[k % 3][1]
        size = pick.choice([85, 92, 96, 100, 100, 110])
        begin = pick.randrange(len(source) - size)
        chars = list(source[begin : begin + size])
        for _ in range(pick.choice([0, 0, 0, 3, 8, 10])):
            at = pick.randrange(len(chars))
            chars[at : at + 1] = pick.choice([[], ["q"], [chars[at], "z"]])
        texts.append(prose(pick, vocab, 12) + "".join(chars) + prose(pick, vocab, 12))
    windows = decontam.Windows(items, decontam.Settings())
    row, window, edits, _, _ = windows.find(pa.array(texts))
    got = {(r, windows.owner[w], w - windows.owner.index(windows.owner[w])) for r, w in zip(row.tolist(), window.tolist())}
    want = {(d, i, p) for d, text in enumerate(texts) for i, item in items
            for p in np.flatnonzero(brute_windows(item.encode(), 100, text.encode()) <= 8).tolist()}
    assert got == want and len({d for d, _, _ in want}) > 15 and edits.max() == 8
    # a verbatim excerpt of the window's size, at each byte in turn
    whole = items[0][1]
    texts = [f"zq {whole[b : b + 100]} zq" for b in range(len(whole) - 100 + 1)]
    found = decontam.find_passages(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(d, 0) for d in range(len(texts))]


# --- sharding

def test_shards(spark):
    pick = random.Random(3)
    texts = ["é" * pick.randint(0, 300) for _ in range(500)] + EDGE
    rows = sharding.balanced_shards(docs_of(spark, texts), 7).collect()
    sizes = [len((t or "").encode()) + 8 for t in texts]
    total, done, shard = sum(sizes), 0, []
    for size in sizes:
        shard.append(7 * (2 * done + size) // (2 * total))
        done += size
    got = {r["doc_id"]: r for r in rows}
    assert [got[i]["shard"] for i in range(len(texts))] == shard
    assert all(got[i]["size"] == sizes[i] and got[i]["text_crc32"] == zlib.crc32((t or "").encode()) for i, t in enumerate(texts))
    for k in range(7):
        assert [got[i]["slot"] for i in range(len(texts)) if shard[i] == k] == list(range(shard.count(k)))
    same = docs_of(spark, ["a"]).union(docs_of(spark, ["a"])).union(spark.createDataFrame([(None, None, None, None)], DOCS))
    assert sorted(r["slot"] for r in sharding.balanced_shards(same, 1).collect()) == [0, 1, 2]
    assert sharding.balanced_shards(same.limit(0)).count() == 0


def test_pairs_of_a_part_go_once_it_is_probed(spark, monkeypatch, tmp_path):
    """They stayed beside all that the scores are made of."""
    monkeypatch.setattr(lm, "new_path", lambda _, label: str(tmp_path / label))
    docs = docs_of(spark, [f"one two {i} three two one {i % 3}" for i in range(50)])
    settings = lm.Settings(part_bytes=1)
    model = lm.train(docs, settings)
    assert model.buckets > 2
    scores = lm.score(docs, model, settings)
    assert list((tmp_path / "levels").rglob("*.parquet")) and not list((tmp_path / "pairs").rglob("*.parquet"))
    assert scores.count() == 50


def test_lm_tokens_of_a_block_know_their_pair(monkeypatch):
    """Numbering the pairs took a hash table and a search, most of the time of scoring."""
    rng = np.random.default_rng(5)
    column = pa.array([" ".join(f"u{w}" for w in rng.zipf(1.3, 40_000) % 50_000) for _ in range(10)] + ["", None, "u1"])
    hashes, at = lm.tokens(column)
    words, numbers = np.unique(np.concatenate([np.array([lm.START], np.uint64), hashes]), return_inverse=True)
    packed = [lm._packed(np.diff(at).astype("<u4")), lm._packed_keys(words), lm._packed(numbers[1:].astype("<u4"))]
    rows = pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], ["sizes", "words", "numbers"])
    own, = lm.Block.each(rows)
    assert (own.keys()[own.pair] == lm.pairs(hashes, at)).all() and (own.numbers == numbers[1:]).all()
    codes = list(zip(own.before, own.after))
    assert codes == sorted(set(codes))

    def without_extras(x, *args, unique=np.unique, **more):
        assert more or len(x) < 1000, "a hash table is filled"
        return unique(x, *args, **more)

    monkeypatch.setattr(np, "unique", without_extras)
    assert len(list(lm.Block.each(rows))) == 1


@pytest.mark.parametrize("probed", [7, 1 << 15])
def test_bloom_filter_is_that_of_its_definition(monkeypatch, probed):
    """Bits and levels key by key, keys of different numbers of hashes in pieces of any size."""
    monkeypatch.setattr(lm, "PROBED", probed)
    rng, size, upper, mask = np.random.default_rng(8), 600, 3, (1 << 32) - 1
    keys = np.sort(rng.integers(0, 2**63, 120, dtype=np.uint64))
    halves = np.unique(keys[::3] >> np.uint64(32)).astype(np.uint32)
    often = lm.Often(halves, (4 + np.arange(len(halves)) % 5).astype(np.uint8), 9)
    levels = rng.integers(1, 5, len(keys))

    def places(key, at, n):
        h = int(lm.texts.mix(np.array([(int(key) + at * 0x9E3779B97F4A7C15) & (1 << 64) - 1], np.uint64))[0])
        low, high = h & mask, h >> 32 | 1
        return [((low + i * high + i * i & mask) * size * 8) >> 32 for i in range(n)]

    def hashes(key, at):
        n = dict(zip(often.halves.tolist(), often.hashes.tolist())).get(int(key) >> 32, often.other)
        return n if at == 1 else min(n, upper)

    bits = np.zeros(size * 8, bool)
    for key, top in zip(keys, levels):
        for at in range(1, top + 1):
            bits[places(key, at, hashes(key, at))] = True
    made = lm.Filter.segment(keys, levels, often.after(keys), size, upper)
    assert made == np.packbits(bits).tobytes()
    asked = np.concatenate([keys, rng.integers(0, 2**63, 400, dtype=np.uint64)])
    want = []
    for key in asked:
        at = 1
        while bits[places(key, at, hashes(key, at))].all():
            at += 1
        want.append(at - 1)
    found = lm.Filter(np.frombuffer(made, np.uint8)[None], 9, often=often, upper=upper).levels(asked)
    assert found.tolist() == want and (found[:120] >= levels).all()
