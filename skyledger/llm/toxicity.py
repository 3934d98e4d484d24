"""Toxic documents by multiple-instance learning: labels are of documents, scores of sentences.

A sentence is toxic with the logistic of a weighted sum of its words, and a document with
the noisy-or of its sentences, 1 - prod(1 - p). The weights are fitted to document labels
through that formula, so the same model that scores a document points at its sentences.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm import texts
from skyledger.session import stage

IS_LETTER = np.zeros(256, bool)
IS_LETTER[65:91] = IS_LETTER[97:123] = IS_LETTER[128:] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line feed ! . ?
PREFIXES = (4, 5, 6, 7, 8, 1 << 20)  # bytes of a word that make a feature


@dataclasses.dataclass(frozen=True)
class Settings:
    """`sample_rows` bounds the labelled rows a model is fitted on, `features` the words that
    get a weight."""

    sample_rows: int = 20_000
    features: int = 2_000
    least_docs: int = 8
    steps: int = 1_000
    rate: float = 0.1
    shrink: float = 2e-4


@dataclasses.dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float


def _words(column: pa.Array):
    """Hash, row and sentence of each feature of the runs of letters; sentences are numbered through the slice.

    Also the first sentence of each row (n + 1 numbers) and the byte each sentence begins at.
    """
    data, at = texts.text_bytes(column)
    letter = IS_LETTER[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = letter[heads]
    last = letter.copy()
    last[:-1] &= ~letter[1:] | first[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    # a word counts whole and by its beginnings, so that endings of a stem need not be learned one by one
    hashes = np.stack([
        texts.hash_spans(data, begin, np.minimum(end, begin + k)) + np.uint64(k) for k in PREFIXES], axis=1).ravel()
    begin = np.repeat(begin, len(PREFIXES))
    # a sentence begins with each row and after each stop
    starts = np.unique(np.concatenate((at[:-1], np.flatnonzero(IS_STOP[data]) + 1)))
    starts = starts[starts < max(len(data), 1)] if len(data) else np.zeros(0, np.int64)
    sentence = np.searchsorted(starts, begin, "right") - 1
    row = np.searchsorted(at, begin, "right") - 1
    return hashes, row, sentence, np.searchsorted(starts, at), starts


def _known(model_words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes have a weight, and the number of that weight."""
    if not len(model_words) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # most words are unknown: a small table of low bits rules them out first
    table = np.zeros(1 << 16, bool)
    table[(model_words & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(model_words, hashes[maybe]), len(model_words) - 1)
    hit = model_words[place] == hashes[maybe]
    return maybe[hit], place[hit]


def _count_words(labelled: DataFrame) -> DataFrame:
    """(`word`, `toxic`, `clean`): labelled documents of each class that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text", 1 << 20):  # what is sorted at once
                hashes, row, *_ = _words(part.column("text"))
                order = np.lexsort((hashes, row))
                hashes, row = hashes[order], row[order]
                new = np.ones(len(row), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
                words, number = np.unique(hashes[new], return_inverse=True)
                marks = part.column("label").to_numpy(zero_copy_only=False)[row[new]]
                toxic = np.bincount(number, marks, minlength=len(words)).astype(np.int64)
                total = np.bincount(number, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], ["word", "toxic", "clean"])

    return (labelled.mapInArrow(run, "word long, toxic long, clean long")
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`text` and `label` of about `sample_rows` documents that `labels` (`doc_id`, `label`) marks.

    Drawn by a hash of doc_id from all labels, of both classes alike, and written once. The
    drawn ids are bounded by that number, so they are broadcast and no text is shuffled. Rows
    with another or no label, or no text, are left out.
    """
    s = settings
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    labels = labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
    n = labels.count()
    share = min(1.0, s.sample_rows / max(n, 1))
    drawn = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_003)) < share * 1_000_003).limit(2 * s.sample_rows)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    return stage(docs.join(F.broadcast(drawn), "doc_id").select("text", "label"), "labelled")


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from the rows (`text`, `label`) of `labelled_sample`.

    Words are counted by class in Spark; the weights are fitted on the driver to the words
    and sentences, as numbers, of these bounded rows. Without rows of both classes the model
    has no words and scores near 0.
    """
    s = settings
    totals = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -12.0)
    share = F.col("toxic") / toxic, F.col("clean") / clean
    mean = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    z = F.abs(share[0] - share[1]) / F.sqrt(mean * (1 - mean + 1e-9) * (1 / toxic + 1 / clean))
    top = (_count_words(labelled).where(F.col("toxic") + F.col("clean") >= s.least_docs)
           .where(z > 5).orderBy(z.desc(), "word").limit(s.features).select("word").collect())
    words = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text"):
                hashes, row, sentence, at, _ = _words(part.column("text"))
                hit, number = _known(words, hashes)
                cut = np.searchsorted(row[hit], np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([
                    part.column("label"), pa.array(np.diff(at)),
                    pa.array([(sentence[hit[a:b]] - at[r]).astype(np.int64) for r, (a, b) in enumerate(zip(cut[:-1], cut[1:]))],
                             pa.list_(pa.int64())),
                    pa.array([number[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.int64())),
                ], ["label", "sentences", "sentence", "word"])

    rows = labelled.mapInArrow(run, "label int, sentences long, sentence array<long>, word array<long>").collect()
    return _solve(words, rows, s)


def _solve(words: np.ndarray, rows: list, s: Settings) -> Model:
    """Gradient ascent on the likelihood of document labels under noisy-or."""
    label = np.array([r["label"] for r in rows], float)
    bag, word, doc_of_bag, plain = [], [], [], []
    for d, r in enumerate(rows):
        ids = {}
        for x, w in zip(r["sentence"], r["word"]):
            bag.append(ids.setdefault(x, len(doc_of_bag)))
            if ids[x] == len(doc_of_bag):
                doc_of_bag.append(d)
            word.append(w)
        plain.append(r["sentences"] - len(ids))
    bag, word, doc_of_bag = (np.array(x, np.int64) for x in (bag, word, doc_of_bag))
    plain = np.array(plain, float)
    n_words, n_bags, n_docs = len(words), len(doc_of_bag), len(rows)
    theta = np.zeros(n_words + 1)
    theta[-1] = -6.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    scale = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    for step in range(1, s.steps + 1):
        z = np.bincount(bag, theta[word], minlength=n_bags) + theta[-1]
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-theta[-1]))
        none = np.bincount(doc_of_bag, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs) + plain * np.log1p(-p0)
        whole = np.maximum(-np.expm1(none), 1e-12)
        push = scale * np.where(label == 1, (1 - whole) / whole, -1.0)
        by_bag = p * push[doc_of_bag]
        grad = np.append(np.bincount(word, by_bag[bag], minlength=n_words), by_bag.sum() + (plain * p0 * push).sum())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        pace = s.rate / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        theta = theta + pace * mean / (1 - 0.9**step)
        # pulls weights to 0 that the labels do not call for
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - np.minimum(pace[:-1], 100.0) * s.shrink, 0.0)
    return Model(words, theta[:-1], float(theta[-1]))


def _sentence_scores(column: pa.Array, model: Model):
    hashes, _, sentence, at, starts = _words(column)
    hit, number = _known(model.words, hashes)
    z = np.bincount(sentence[hit], model.weights[number], minlength=len(starts)) + model.bias
    return 1 / (1 + np.exp(-z)), at, starts


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` of each whole text in 0 to 1, and `offending`, its sentences of 0.5 or more.

    One row per row of docs (`doc_id`, `text`; other columns are left aside). A null or
    empty text has no sentence and so a score of 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text"):
                scores, offending = _document_scores(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array(offending)], ["doc_id", "score", "offending"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, score double, offending long")


def _document_scores(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    p, at, _ = _sentence_scores(column, model)
    none = texts.row_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), at)
    return np.clip(-np.expm1(none), 0.0, 1.0), texts.row_sums((p >= 0.5).astype(np.int64), at)


def keep_clean(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, whose `text` scores less than `below`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text"):
                yield part.filter(pa.array(_document_scores(part.column("text"), model)[0] < below))

    return docs.mapInArrow(run, docs.schema)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Sentences scored `least` or more: `doc_id`, `sentence` number from 0, `start` and `bytes`
    (UTF-8, within the text), the sentence's `text` and its `score`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text"):
                p, at, starts = _sentence_scores(part.column("text"), model)
                data, byte_at = texts.text_bytes(part.column("text"))
                found = np.flatnonzero(p >= least)
                row = np.searchsorted(at, found, "right") - 1
                ends = np.append(starts[1:], len(data))
                ids = part.column("doc_id").take(pa.array(row))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(found - at[row]), pa.array(starts[found] - byte_at[row]), pa.array(ends[found] - starts[found]),
                    pa.array([data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace") for i in found], pa.string()),
                    pa.array(p[found])], ["doc_id", "sentence", "start", "bytes", "text", "score"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, sentence long, start long, bytes long, text string, score double")
