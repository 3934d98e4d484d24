from __future__ import annotations

import base64
import gzip
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skyledger.llm import chat, embeddings, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")


# --- archives

def pages_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.withColumn("captured", F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + 1_700_000_000)).withColumn("run", F.lit(1))


def test_archives_round_trip(spark):
    tricky = "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(5, "http://www.a.org/x?q=1#f", "same"), (3, "https://a.org:8443/", "same"), (9, "http://b.a.org", tricky), (1, None, None),
            (2, "not a url", ""), (7, "http://a.org/x?q=1", tricky), (8, "http://c.org/\r\n", "é" * 50_000), (None, "http://d.org", "same"),
            (3, "https://a.org:8443/", "same")]
    got = warc.archive_and_index(pages_of(spark, rows)).collect()
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = page != first[html or ""]
        want.append((str(page), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if revisit else "response", first[html or ""] if revisit else None))
    columns = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, [(str(r["page_id"]), *[r[c] for c in columns]) for r in got])) == sorted(map(str, want))
    assert warc.archive_and_index(pages_of(spark, rows).limit(0)).count() == 0


def test_index_is_in_global_order(spark):
    pick = random.Random(1)
    rows = [(i, pick.choice(["http://hot.org/a", f"http://s{i % 9}.org/{i % 5}"]), f"text {i}") for i in range(600)]
    path_rows = warc.decide(pages_of(spark, rows))
    folder = spark.conf.get("spark.checkpoint.dir") + "/archives-in-order"
    warc.write_archives(path_rows, folder, records_per_archive=70)
    runs = warc.stage(warc.read_runs(spark, folder), "runs")
    assert runs.select("run").distinct().count() > 8
    got = warc.merged_index(runs, entries_per_range=100).orderBy("index_range", "index_place").collect()
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in got]
    assert keys == sorted(keys) and len(keys) == 600 and len({r["index_range"] for r in got}) > 3


def test_histories_span_ranges(spark):
    """A URL with most captures lies in many ranges, and others straddle one edge."""
    pick = random.Random(6)
    urls = [f"http://{x}.org/" for x in "abcdefgh"] + ["http://hot.org/"] * 20
    rows = [(i, pick.choice(urls), f"text {i}") for i in range(700)]
    folder = spark.conf.get("spark.checkpoint.dir") + "/archives-hot"
    warc.write_archives(warc.decide(pages_of(spark, rows)), folder, records_per_archive=60)
    runs = warc.stage(warc.read_runs(spark, folder), "runs")
    for size in (20, 50, 300, 10_000):
        got = warc.merged_index(runs, entries_per_range=size).orderBy("index_range", "index_place").collect()
        seen = {}
        for r in got:
            assert r["capture"] == seen.get(r["url_key"], 0)
            seen[r["url_key"]] = r["capture"] + 1
        assert len(got) == 700 and [(r["url_key"], r["page_id"]) for r in got] == sorted((r["url_key"], r["page_id"]) for r in got)


def one_record(i, size):
    body = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % size + random.Random(i).randbytes(size)
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d" % (i, len(body))
    return head + b"\r\n\r\n" + body + b"\r\n\r\n", body


@pytest.mark.parametrize("members", [1, 7, 200])
def test_archives_of_many_members(members, monkeypatch):
    whole = [one_record(i, pick) for i, pick in enumerate([0, 10, 3_000, 70_000] * 50)]
    step = -(-len(whole) // members)
    packed = [gzip.compress(b"".join(r for r, _ in whole[i : i + step])) for i in range(0, len(whole), step)]
    raw = b"".join(packed)
    edge = len(packed[0])  # a member that ends where a part does
    for part in {1 << 18, edge, 1_000, 2 * edge}:
        monkeypatch.setattr(warc.Unzipped.__init__, "__defaults__", (part,))
        assert [b for _, b in warc.records(raw)] == [b for _, b in whole]
    assert len(list(warc.records(raw + b"\0" * 700))) == len(whole)
    for cut in (len(raw) - 1, len(raw) - 9, len(raw) // 2, len(raw) - len(packed[-1]) // 2):
        with pytest.raises((ValueError, EOFError)):
            list(warc.records(raw[:cut]))
    assert not list(warc.records(b"")) and not list(warc.records(gzip.compress(b"")))


def test_what_unpacks_to_much_is_read_in_parts():
    source = warc.Unzipped(gzip.compress(b"0" * 50_000_000))
    seen = 0
    while source.more():
        assert len(source.held) <= 4 * source.part
        seen += len(source.held)
        source.held.clear()
    assert seen == 50_000_000


def test_archives_are_cut_by_bytes(spark):
    pick = random.Random(3)
    rows = [(i, f"http://a.org/{i}", "".join(pick.choices("abcdefghijklmnop ", k=n)))
            for i, n in enumerate([10] * 300 + [5_000] * 60 + [40_000] * 20 + [300_000] * 3)]
    folder = spark.conf.get("spark.checkpoint.dir") + "/archives-by-bytes"
    pages = pages_of(spark, rows).coalesce(1)
    warc.write_archives(warc.decide(pages), folder, records_per_archive=100, archive_bytes=200_000)
    runs = warc.read_runs(spark, folder).groupBy("run").agg(F.sum("payload_bytes").alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in runs) == len(rows) and max(r["n"] for r in runs) <= 100
    assert all(r["bytes"] <= 200_000 or r["n"] == 1 for r in runs)


def test_loser_tree_merges():
    pick = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((f"k{pick.randrange(20)}", str(pick.randrange(9)), pick.randrange(50), f"r{i}", n) for n in range(pick.randrange(12)))
                for i in range(k)]
        assert list(warc.merge_runs(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTP://WWW.Example.org:80/A?b=C#d") == "org,example)/a?b=c"
    assert warc.url_key("https://m.example.org:8443") == "org,example,m:8443)/"
    assert warc.url_key("-") == "-"


# --- conversations

def test_conversations_round_trip(spark):
    pick = random.Random(3)
    bits = ["\\", "###", "</turn>", "### Assistant: ", ":", "a", " ", "\n", "é", "🙂", "<|endoftext|>", "\\### ", "\\\\"]
    rows = []
    for conv in range(30):
        for turn in range(pick.randint(1, 6)):
            rows.append((conv, turn, pick.choice(["user", "assistant", "system", "tool:x", "###", "\\", ""]), "".join(pick.choices(bits, k=pick.randint(0, 9)))))
    rows += [(99, 0, None, None), (99, 1, "assistant", None), (None, 0, "user", "x"), (77, None, "assistant", "first"), (77, 0, "assistant", "y" * 100_000)]
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("x"))
    formatted = chat.format_turns(frame, PATH)
    got = {r["conv_id"]: r for r in chat.read_back(formatted, PATH).collect()}
    shown = {}
    for r in chat.render(formatted, PATH).collect():
        shown[r["conv_id"]] = shown.get(r["conv_id"], 0) + len(r["shown"])
    assert len(got) == len({r[0] for r in rows})
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["formatted_chars"] == shown[conv]
    assert chat.read_back(chat.format_turns(frame.limit(0), PATH), PATH).count() == 0


def test_escape_hides_control_strings():
    text = r"\### Assistant: </turn> ok"
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and hidden == r"\\\### Assistant: \</turn> ok"


# --- vectors

@pytest.mark.parametrize("block", [512, 5])
def test_vectors_match_brute_force(spark, block):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(160):
        base = rng.normal(size=24)
        rows.append([i, base.tolist(), i % 3])
    for i in range(160, 260):
        src = rows[int(rng.integers(0, 40))]
        rows.append([i, (np.array(src[1]) + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.2])).tolist(), src[2]])
    rows += [[300, None, 1], [301, [0.0] * 24, 1], [302, [float("nan")] * 24, 1], [303, [1.0] * 24, None], [304, [1.0] * 24, None],
             [305, [1.0, None], 1], [306, [2.0, 1.0], 1], [307, [4.0, 2.0], 1], [308, [], 1], [309, [1e300] * 24, 2], [310, [3e-300] * 24, 2]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("x"))
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame, embeddings.Settings(block=block)).collect()}
    fine = {i: np.array(v, float) / np.abs(np.array(v, float)).max() for i, v, label in rows
            if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {r[0]: r[2] for r in rows}
    links, top = {r[0]: set() for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in fine:
        for b in fine:
            if a < b and label[a] == label[b] and len(fine[a]) == len(fine[b]):
                if fine[a] @ fine[b] / np.sqrt((fine[a] @ fine[a]) * (fine[b] @ fine[b])) >= 0.98:
                    links[a].add(b), links[b].add(a)
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in links.items()}
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in links}
    assert embeddings.near_vectors(frame.limit(0)).count() == 0
