"""Ranked lexical search without random access: sorted reads and score intervals.

Documents are read once, by bytes, into segments of bounded size that hold the postings of
the queries' terms. Within a segment, each term's postings go by falling impact. A query
reads its lists from the top in step; a document's score lies between what was read of it and
that plus the next impact of every list it was not met in. Reading goes on until the best
documents, their order and their scores are certain. Segments' best are merged at the end, so
the postings of a term that most documents hold lie in as many segments as there are.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm import texts
from skyledger.session import stage

# Terms are runs of ASCII letters, digits and all that is not ASCII; A-Z are read as a-z.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x80:] = True
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

SCALE = 1_000_000_000


@dataclasses.dataclass(frozen=True)
class Settings:
    """`best` documents a query. `segment_bytes` of text make a segment (or one longer text);
    queries are searched in blocks of at most `query_bytes` of text, which bounds what a
    task is sent; `first_read` postings of a list are read at first, then twice as many each time."""

    best: int = 10
    segment_bytes: int = 32 << 20
    query_bytes: int = 4 << 20
    stretch_bytes: int = 1 << 20
    first_read: int = 64


def terms(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the rows in order, and the row of each; `data` are bytes, `at` where rows begin."""
    solid = IS_TERM[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = solid[heads]
    begin = np.flatnonzero(first)
    kept = LOWER[data[solid]]
    place = np.cumsum(solid) - solid  # bytes of terms before each byte
    ends = np.append(place[begin], len(kept)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return found, np.searchsorted(at, begin, side="right") - 1


def stretches(data: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of the bytes about `size` apart, between rows or before a byte that is in no term."""
    begin = 0
    while begin < len(data):
        end = begin + size
        if end >= len(data):
            end = len(data)
        else:
            # the next row, or the next byte outside terms, whichever comes first
            row = int(at[np.searchsorted(at, end)])
            window, gap = 4096, None
            while gap is None and end < row:
                open_bytes = np.flatnonzero(~IS_TERM[data[end : min(row, end + window)]])
                if len(open_bytes):
                    gap = end + int(open_bytes[0])
                    break
                end, window = min(row, end + window), window * 2
            end = gap if gap is not None else row
        yield begin, end
        begin = end


def query_terms(text: str | None) -> list[bytes]:
    """Distinct terms of a query, in order of their bytes."""
    data, at = texts.text_bytes(pa.array([text], pa.string()))
    return sorted(set(terms(data, at)[0].to_pylist()))


@dataclasses.dataclass
class Query:
    """A query's key, its terms' numbers in the block's vocabulary, and their weights."""

    key: int
    terms: np.ndarray
    weights: np.ndarray


class Segment:
    """Impact-sorted postings of some documents: each term's by falling impact, then document."""

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, term: np.ndarray, doc: np.ndarray, times: np.ndarray,
                 n_docs: int, n_terms: int):
        self.docs = docs  # identifiers
        m = 100 - 90 + (90 * sizes * n_docs) // max(n_terms, 1)
        impact = (SCALE * times) // (1000 * times + 8 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.term, self.doc, self.impact = term[order], doc[order], impact[order]

    def list_of(self, term: int) -> slice:
        return slice(*np.searchsorted(self.term, [term, term + 1]))


def no_random_access(segment: Segment, query: Query, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the segment's best documents, best first, equal scores by identifier.

    Each list is read from its top, `first_read` postings and then twice as many. `low` sums
    what was read of a document, `high` adds the next impact of every list it was not met in;
    documents not met at all have such an interval too. It ends when every document that can
    still reach the best is known exactly, which settles membership, ties and scores.
    """
    lists, weights = [], []
    for term, weight in zip(query.terms, query.weights):
        own = segment.list_of(term)
        if weight > 0 and own.stop > own.start:
            lists.append(own)
            weights.append(int(weight))
    none = np.zeros(0, np.int64)
    if not lists:
        return none, none
    at = np.array([x.start for x in lists])
    end = np.array([x.stop for x in lists])
    weight = np.array(weights, np.int64)
    low = np.zeros(len(segment.docs), np.int64)
    met = np.zeros((len(lists), len(segment.docs)), bool)
    step = s.first_read
    while True:
        for i, w in enumerate(weights):
            if at[i] < end[i]:
                own = slice(at[i], min(at[i] + step, end[i]))
                docs = segment.doc[own]  # a list names a document once
                low[docs] += segment.impact[own] * w
                met[i, docs] = True
                at[i] = own.stop
        step *= 2
        ahead = np.where(at < end, segment.impact[np.minimum(at, end - 1)] * weight, 0)
        high = low.copy()
        for i in np.flatnonzero(ahead):
            np.add(high, ahead[i], out=high, where=~met[i])
        bar = np.partition(low, len(low) - s.best)[len(low) - s.best] if len(low) > s.best else 0
        # who reaches the bar exactly may still win by its identifier
        able = np.flatnonzero((high >= bar) & (high > 0))
        if (high[able] == low[able]).all():
            break
    order = able[np.lexsort((segment.docs[able], -low[able]))][: s.best]
    return order, low[order]


def _term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(queries: DataFrame, s: Settings) -> Iterator[list]:
    """Queries in blocks of bounded text, read a partition at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        own = len(row["text"] or "")
        if block and size + own > s.query_bytes:
            yield block
            block, size = [], 0
        block.append(row)
        size += own
    if block:
        yield block


def index(docs: DataFrame, vocabulary: list[bytes], settings: Settings = Settings()) -> DataFrame:
    """Segments of docs (`doc_id`, `text`) with the postings of the vocabulary's terms.

    One row per segment: `docs`, `sizes` (64-bit words: identifiers, terms with repeats),
    `term`, `doc`, `times` (32-bit words: one entry per term and document), `n_docs`
    (documents with a term), `n_terms`, and `seen` with the documents that hold each term.
    A document without a term is in no segment; nor is one without a doc_id, which is counted all the same.
    """
    s = settings
    wanted = pa.array(vocabulary, pa.large_binary())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # at most query_bytes

    def counted(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each row, and (row, term, times) of the wanted ones."""
        data, at = texts.text_bytes(column)
        sizes = np.zeros(len(column), np.int64)
        width = max(len(vocabulary), 1)
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b in stretches(data, at, s.stretch_bytes):
            inside = np.clip(at, a, b) - a
            found, row = terms(data[a:b], inside)
            # rows that end before the stretch are empty in it, so places fall to the last that begins
            sizes += np.bincount(row, minlength=len(column))
            number = pc.index_in(found, value_set=sent.value)
            known = number.is_valid().to_numpy(zero_copy_only=False)
            key = row[known].astype(np.int64) * width + number.drop_null().to_numpy()
            key, n = np.unique(key, return_counts=True)
            keys, times = np.concatenate((keys, key)), np.concatenate((times, n))
        keys, place = np.unique(keys, return_inverse=True)
        return sizes, keys // width, keys % width, np.bincount(place, times, len(keys)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in texts.slices(batch, "text", s.stretch_bytes):
                sizes, row, term, times = counted(part.column("text"))
                ids = part.column("doc_id")
                named = ids.is_valid().to_numpy(zero_copy_only=False)
                held.append((ids.fill_null(0).to_numpy(), named, sizes, row, term, times))
                size += part.column("text").nbytes
                if size >= s.segment_bytes:
                    yield segment(held)
                    held, size = [], 0
        if held:
            yield segment(held)

    def segment(held) -> pa.RecordBatch:
        ids, named, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1, 2))
        base = np.cumsum([0, *(len(h[0]) for h in held)])
        row = np.concatenate([h[3] + b for h, b in zip(held, base)])
        term, times = (np.concatenate([h[i] for h in held]) for i in (4, 5))
        number, df = np.unique(term, return_counts=True)
        used = named & (sizes > 0)
        place = np.cumsum(used) - 1
        kept = used[row]
        seen = [{"term": t, "df": d} for t, d in zip(number.tolist(), df.tolist())]
        return pa.RecordBatch.from_arrays([
            pa.array([ids[used].astype("<i8").tobytes()], pa.binary()), pa.array([sizes[used].astype("<i8").tobytes()], pa.binary()),
            *(pa.array([x[kept].astype("<i4").tobytes()], pa.binary()) for x in (term, place[row], times)),
            pa.array([int((sizes > 0).sum())], pa.int64()), pa.array([int(sizes.sum())], pa.int64()),
            pa.array([seen], pa.list_(pa.struct([("term", pa.int32()), ("df", pa.int64())])))],
            ["docs", "sizes", "term", "doc", "times", "n_docs", "n_terms", "seen"])

    return rows.mapInArrow(run, "docs binary, sizes binary, term binary, doc binary, times binary, "
                                "n_docs long, n_terms long, seen array<struct<term:int,df:long>>")


def search(docs: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The best documents of every query: `query` (its number), `item_id`, `rank`, `doc_id`, `score`.

    docs: `doc_id`, `text`; queries: `item_id`, `text`; other columns are left aside. Every
    row of queries is a query of its own, also if it repeats another, and every row of docs a
    document. Ranks are 1, 2, ...; equal scores go by ascending doc_id. A null or empty query
    finds nothing, nor do documents with a score of 0; a document without a doc_id is never
    found. An empty table gives an empty result.

    The documents' terms, in how many documents each query's terms occur and how long
    documents are, are counted over all documents. Queries too long for one block are
    searched in several passes, one block's postings at a time.
    """
    s = settings
    spark = docs.sparkSession
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found, before = None, 0
    for block in _blocks(rows, s):
        own = [query_terms(r["text"]) for r in block]
        vocabulary = sorted({t for x in own for t in x})
        number = {t: i for i, t in enumerate(vocabulary)}
        segments = stage(index(docs, vocabulary, s), "segments")
        n_docs, n_terms = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        # one row per term of the block
        df = dict(segments.select(F.explode("seen").alias("x")).groupBy("x.term").agg(F.sum("x.df")).collect())
        weight = [_term_weight(n_docs, df[i]) if i in df else 0 for i in range(len(vocabulary))]
        asked = []
        for i, x in enumerate(own):
            numbers = np.array([number[t] for t in x], np.int64)
            asked.append(Query(before + i, numbers, np.array([weight[j] for j in numbers], np.int64)))
        best = stage(_best(segments, asked, int(n_docs or 0), int(n_terms or 0), s), "best")
        keys = spark.createDataFrame([(before + i, r["item_id"]) for i, r in enumerate(block)], "query long, item_id long")
        best = best.join(F.broadcast(keys), "query")  # at most query_bytes
        found = best if found is None else found.unionByName(best)
        before += len(block)
    if found is None:
        return spark.createDataFrame([], "query long, item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.best)
    return ranked.select("query", "item_id", "rank", "doc_id", "score")


def _best(segments: DataFrame, asked: list[Query], n_docs: int, n_terms: int, s: Settings) -> DataFrame:
    sent = segments.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                read = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind).astype(np.int64)
                segment = Segment(read("docs", "<i8"), read("sizes", "<i8"), read("term", "<i4"), read("doc", "<i4"),
                                  read("times", "<i4"), n_docs, n_terms)
                for query in sent.value:
                    places, scores = no_random_access(segment, query, s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), query.key, np.int64)), pa.array(segment.docs[places]), pa.array(scores)],
                        ["query", "doc_id", "score"])

    few = segments.select("docs", "sizes", "term", "doc", "times")
    return few.mapInArrow(run, "query long, doc_id long, score long")
