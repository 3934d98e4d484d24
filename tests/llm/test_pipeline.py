from __future__ import annotations

import random

import corpus_pipeline


def test_stages_filter_and_keep_columns(spark, tmp_path):
    pick = random.Random(5)
    words = {"xx": [a + b for a in ("ti", "me", "ou", "et", "la", "vi") for b in ("on", "nt", "x", "te", "re", "que")],
             "yy": [a + b for a in ("sch", "ke", "un", "he", "ge", "zw") for b in ("aft", "it", "g", "rn", "ich", "tz")]}
    make = lambda lang, n: " ".join("".join(pick.choices(words[lang], k=2)) for _ in range(n))
    passage = make("xx", 40)
    rows, toxic = [], set()
    for i in range(200):
        lang = "xx" if i % 2 else "yy"
        text = make(lang, 80)
        if i % 10 == 3:
            toxic.add(i)
            text += ". you grubble " + make(lang, 3)
        rows.append((i, text, lang, "s", len(text)))
    rows += [(300, rows[4][1], "yy", "s", 1), (301, rows[7][1] + " more", "xx", "s", 1), (302, make("xx", 30) + " " + passage + " " + make("xx", 30), "xx", "s", 1),
             (303, None, "xx", "s", None), (304, "12 34", "xx", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone, kept = [], docs
    for k, (name, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        step(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert kept.columns == docs.columns
        gone.append(before - {r["doc_id"] for r in kept.select("doc_id").collect()})
    assert gone == [{303, 304}, toxic, {300, 301}, {302}]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.collect()}


def tables(spark, folder, docs, labels, benchmark):
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
             "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for (name, kind), rows in zip(kinds.items(), (docs, labels, benchmark)):
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_empty_tables_give_an_empty_corpus(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [], [])).count() == 0


def test_repeated_rows_and_documents_without_labels_or_benchmark(spark, tmp_path):
    """Equal rows are one group of copies, and one of them stays; no label and no item drop nothing."""
    pick = random.Random(9)
    text = lambda: " ".join("".join(pick.choices("abcdefgh", k=6)) for _ in range(60))
    rows = [(i, text(), "xx", "s", 1) for i in range(20)]
    sf_dir = tables(spark, tmp_path, rows + [rows[3], rows[3], (50, rows[4][1], None, None, None)], [], [])
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == set(range(20))
    assert sorted(r["doc_id"] for r in pieces if r["piece"] == 0) == list(range(20))
