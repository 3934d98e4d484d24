"""Language-model scores from a log-frequency Bloom filter of word pairs.

The filter holds each pair seen in training with its count on a logarithmic scale: level 1
up to its own are inserted, and a look-up probes level after level until one is missing.
Pairs are discounted, and what a context word has left goes to the smoothed probabilities of
single words, whose counts are exact. A pair that was not seen may still seem to be there; the
number of hashes grows with the vocabulary, so that all such pairs after a word get little
together, and what they are expected to get is taken from the single words' share. What a
false hit gives falls with the count of the word before, so pairs after frequent words are
held by fewer hashes; and as a higher level counts only where the first is held, those
take few. The filter grows with the corpus; it is broadcast a part of bounded size at a
time. Texts are read once: what is staged of them is the number of each word, and the distinct
pairs of a block of texts, laid out by part, so that a part probes only the pairs that it may hold.

Hashes of words stand for words: 64 bits for single words, 32 and 32 for pairs.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skyledger.llm import texts
from skyledger.session import hadoop_path, new_path, stage

END = texts.mix(np.array([0xE0D], np.uint64))[0]  # the closing token
START = texts.mix(np.array([0x57A27], np.uint64))[0]  # what stands before the first

PROBED = 1 << 15  # keys whose bits are set or asked at a time
BIT = np.array([128 >> i for i in range(8)], np.uint8)  # of a byte


@dataclasses.dataclass(frozen=True)
class Settings:
    """`part_bytes` bounds what is broadcast at a time; unseen pairs that the filter seems to
    hold get at most `false_mass` of probability after any word, in expectation; pairs of a
    count below `least` are left to the single words. Levels above the first take
    `upper_hashes`; words seen `often` times or more have fewer hashes after them, as far as a
    table of `most_often` words holds the most frequent. `block_bytes` of text are scored at a time, and counts are
    merged in buckets of about `bucket_bytes` of text."""

    part_bytes: int = 32 << 20
    false_mass: float = 0.02
    base: float = 2.0**0.5
    least: int = 1
    discount: float = 0.75
    upper_hashes: int = 6
    often: int = 64
    most_often: int = 1 << 20
    chunk_bytes: int = 8 << 20
    block_bytes: int = 4 << 20
    bucket_bytes: int = 8 << 20


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row with a closing token, and where each row begins."""
    data, at = texts.text_bytes(column)
    hashes, starts = texts.hashed_words(data, at)
    ends = starts[1:] + np.arange(len(starts) - 1)
    out = np.empty(len(hashes) + len(ends), np.uint64)
    closing = np.zeros(len(out), bool)
    closing[ends] = True
    out[closing], out[~closing] = END, hashes
    return out, np.concatenate(([0], ends + 1))


def pairs(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context word (upper half) and word (lower half) at each token."""
    return pair_keys(shifted(hashes, at, START), hashes)


def shifted(own: np.ndarray, at: np.ndarray, start) -> np.ndarray:
    """What stands before each token; `start` before the first of a row."""
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[at[:-1]] = start
    return before


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return ((before >> np.uint64(32)) << np.uint64(32)) | (after >> np.uint64(32))


def bucket_of(half: np.ndarray, n: int) -> np.ndarray:
    """Bucket of single words, from the upper half of their hash."""
    return (texts.mix(half) % np.uint64(n)).astype(np.int64)


def pair_bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((texts.mix(keys ^ np.uint64(0xB10C)) >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def level(counts: np.ndarray, least: int, base: float) -> np.ndarray:
    """1 for `least`, one more with each factor `base`."""
    return 1 + np.floor(np.log(counts / least) / np.log(base) + 1e-9).astype(np.int64)


def typical(levels: np.ndarray, least: int, base: float) -> np.ndarray:
    """A count that stands for a level: the lowest of it."""
    return np.ceil(least * base ** (levels - 1.0) - 1e-9)


def believed(levels: np.ndarray, least: int, base: float) -> np.ndarray:
    """Levels as found, or the next below that some count has: what no count has is a false hit."""
    every = np.arange(1, int(levels.max(initial=1)) + 1)
    real = level(typical(every, least, base), least, base) == every
    real[0] = True
    return np.concatenate(([0], np.maximum.accumulate(np.where(real, every, 0))))[levels]


def hashes_for(distinct: int, s: Settings) -> int:
    """So many that at half of the bits set, unseen pairs after a word seen once get `false_mass`."""
    return max(4, int(np.ceil(np.log2(max(distinct, 1) * (s.least - s.discount) / s.false_mass))))


@dataclasses.dataclass
class Often:
    """Upper halves of frequent words' hashes, in order, and how many hashes hold a pair after each.

    Counts add up to the number of tokens, so no more than `most_often` words can have
    the count that is asked for.
    """

    halves: np.ndarray
    hashes: np.ndarray
    other: int

    @staticmethod
    def of(halves: np.ndarray, counts: np.ndarray, distinct: int, s: Settings) -> Often:
        other = hashes_for(distinct, s)
        kept, place = np.unique(halves, return_inverse=True)
        least = np.full(len(kept), np.iinfo(np.int64).max)
        np.minimum.at(least, place, counts)
        saved = np.floor(np.log2(least)).astype(np.int64) if len(kept) else least
        return Often(kept, np.maximum(4, other - saved).astype(np.uint8), other)

    def after(self, keys: np.ndarray) -> np.ndarray:
        """The number of hashes of each pair, by its first word."""
        out = np.full(len(keys), self.other, np.uint8)
        if len(self.halves):
            context = (keys >> np.uint64(32)).astype(np.uint32)
            place = np.minimum(np.searchsorted(self.halves, context), len(self.halves) - 1)
            out = np.where(self.halves[place] == context, self.hashes[place], out)
        return out


def _split(bucket: np.ndarray, n: int, *arrays: np.ndarray):
    """(bucket, arrays of its entries) for each bucket that has some."""
    if n <= 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by radix
    order = np.argsort(bucket, kind="stable")
    cut = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=n))))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), *(a[order[cut[b] : cut[b + 1]]] for a in arrays)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their counts."""
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: high bytes are mostly alike."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _read(column, kind: str) -> Iterator[np.ndarray]:
    return (_unpacked(x.as_buffer(), kind) for chunk in getattr(column, "chunks", [column]) for x in chunk)


def _read_keys(column) -> Iterator[np.ndarray]:
    return (np.cumsum(x, dtype=np.uint64) for x in _read(column, "<u8"))


class Filter:
    """Segments of one bit array; a pair's bucket names its segment.

    `segments` are those of buckets `first` and on, of `buckets` in all. `often` says how
    many of the `hashes` hold a pair; without it all do.
    """

    def __init__(self, segments: np.ndarray, hashes: int, first: int = 0, buckets: int | None = None,
                 often: Often | None = None, upper: int = 6):
        self.segments, self.hashes = segments, hashes  # buckets x bytes
        self.first, self.buckets = first, buckets or len(segments)
        self.often, self.upper = often, min(upper, hashes)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether the segments of the keys are here."""
        bucket = pair_bucket(keys, self.buckets)
        return (bucket >= self.first) & (bucket < self.first + len(self.segments))

    @staticmethod
    def halves(keys: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each key at a level, and the step to the next."""
        h = texts.mix(keys + np.uint64(at * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        return h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    @staticmethod
    def place(at: np.ndarray, bits: int) -> np.ndarray:
        """The bit that a place of 32 bits stands for."""
        return (at.astype(np.uint64) * np.uint64(bits)) >> np.uint64(32)

    @staticmethod
    def onward(at: np.ndarray, step: np.ndarray, i: int) -> None:
        """From the places by hash `i` to those by the next: `i` steps and a square from the first."""
        at += step
        at += np.uint32(2 * i + 1)

    @staticmethod
    def segment(keys: np.ndarray, levels: np.ndarray, hashes, size: int, upper: int = 6) -> bytes:
        """The bit array of `size` bytes with every level of every key inserted; `hashes` of all keys, or of each."""
        bits = np.zeros(size * 8, bool)
        order = _most_first(np.broadcast_to(hashes, keys.shape))
        keys, levels, hashes = keys[order], levels[order], np.broadcast_to(hashes, keys.shape)[order]
        for at in range(1, int(levels.max(initial=0)) + 1):
            going = levels >= at
            keys, hashes, levels = keys[going], hashes[going], levels[going]
            if at == 2:
                hashes = np.minimum(hashes, upper)
            for begin in range(0, len(keys), PROBED):
                own = slice(begin, begin + PROBED)
                (low, high), more = Filter.halves(keys[own], at), _with_more(hashes[own])
                for i, n in enumerate(more):
                    bits[Filter.place(low[:n], size * 8)] = True
                    Filter.onward(low[:n], high[:n], i)
        return np.packbits(bits).tobytes()

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """How many levels of each key are present, probing upwards until one is missing."""
        out = np.zeros(len(keys), np.int64)
        for begin in range(0, len(keys), PROBED):
            own = slice(begin, begin + PROBED)
            self._probe(keys[own], out[own])
        return out

    def _probe(self, keys: np.ndarray, out: np.ndarray) -> None:
        """Levels of a few keys, as many as a processor's cache holds with what is made of them.

        Keys of more hashes come first, so a hash asks the front of them. Most that pass the
        first hashes are there: the others are only marked, and left out once they are many.
        """
        size, flat = self.segments.shape[1], self.segments.reshape(-1)
        hashes = self.often.after(keys) if self.often else np.full(len(keys), self.hashes, np.uint8)
        going, at = _most_first(hashes), 1
        hashes = hashes[going]
        base = ((pair_bucket(keys, self.buckets) - self.first) * size)[going]
        while len(going):
            low, high = self.halves(keys[going], at)
            present, more, i = np.ones(len(going), bool), _with_more(hashes), 0
            while i < len(more):
                n = more[i]
                p = self.place(low[:n], size * 8).view(np.int64)
                there = flat.take(base[:n] + (p >> 3)) & BIT.take(p & 7) != 0
                self.onward(low[:n], high[:n], i)
                i += 1
                present[:n] &= there
                if np.count_nonzero(present) < 0.9 * len(present):
                    going, hashes, base, low, high = (x[present] for x in (going, hashes, base, low, high))
                    present, more = np.ones(len(going), bool), _with_more(hashes)
            going, hashes, base = (x[present] for x in (going, hashes, base))
            out[going] = at
            if at == 1:
                hashes = np.minimum(hashes, self.upper)
            at += 1


def _most_first(hashes: np.ndarray) -> np.ndarray:
    """The order of keys by their number of hashes, the highest first."""
    return np.argsort(hashes.astype(np.uint8), kind="stable")[::-1]  # sorted by radix


def _with_more(hashes: np.ndarray) -> np.ndarray:
    """How many keys have more than 0, 1, ... hashes, as long as any has."""
    return (len(hashes) - np.cumsum(np.bincount(hashes)))[:-1] if len(hashes) else np.zeros(0, np.int64)


@dataclasses.dataclass
class Model:
    """`words`: exact counts and pair mass by bucket; `pairs`: exact pair counts by bucket, of
    which a filter segment of `segment_bytes` is made for each bucket, by `hashes` hashes that an
    unseen pair passes at `rate`, or by fewer after a word of `often`. Both are staged tables."""

    words: DataFrame
    pairs: DataFrame
    segment_bytes: int
    hashes: int
    rate: float
    buckets: int
    tokens: int
    distinct: int
    often: Often

    def part_buckets(self, part_bytes: int) -> int:
        """Buckets of a part of the filter: as many as `part_bytes` hold, or one."""
        return max(1, part_bytes // self.segment_bytes)


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Counts words and pairs of all texts (`text`; null is empty).

    Counts are summed per chunk of text in tasks, then merged by bucket, so a frequent word
    or pair is one entry per chunk. Only totals and the words of `Often` come to the driver.
    """
    s = settings
    docs = docs.select("text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(8, -(-total // s.bucket_bytes)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in texts.slices(batch, "text"):
                own, at = tokens(part.column("text"))
                held.append((own, pairs(own, at)))
                size += part.column("text").nbytes
                if size >= s.chunk_bytes:
                    yield from counted(held)
                    held, size = [], 0
        if held:
            yield from counted(held)

    def counted(held):
        for kind, bucket in ((0, lambda k: bucket_of(k >> np.uint64(32), n)), (1, lambda k: pair_bucket(k, n))):
            keys, counts = np.unique(np.concatenate([h[kind] for h in held]), return_counts=True)
            out = [(kind, b, _packed_keys(k), _packed(c))
                   for b, k, c in _split(bucket(keys), n, keys, counts.astype("<u4"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                ["kind", "bucket", "keys", "counts"])

    def merge(group: pa.Table) -> pa.Table:
        kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
        keys, counts = _merge(list(_read_keys(group.column("keys"))),
                              [c.astype(np.int64) for c in _read(group.column("counts"), "<u4")])
        distinct, everything = len(keys), int(counts.sum())
        if kind:
            keep = counts >= s.least
            keys, counts = keys[keep], counts[keep]
        return pa.table({
            "kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()),
            "distinct": pa.array([distinct], pa.int64()), "total": pa.array([everything], pa.int64()),
            "keys": pa.array([_packed_keys(keys)], pa.binary()), "counts": pa.array([_packed(counts)], pa.binary())})

    schema = ("kind int, bucket int, distinct long, total long, keys binary, counts binary")
    merged = stage(docs.mapInArrow(count, "kind int, bucket int, keys binary, counts binary")
                   .groupBy("kind", "bucket").applyInArrow(merge, schema), "ngrams")
    word_totals = merged.where("kind = 0").agg(F.sum("distinct"), F.sum("total")).first()
    n_tokens, n_distinct = int(word_totals[1] or 0), int(word_totals[0] or 0)
    seen_often = max(s.often, -(-n_tokens // s.most_often))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(_read_keys(batch.column("keys")), _read(batch.column("counts"), "<i8")):
                picked = c >= seen_often
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(k[picked] >> np.uint64(32)).astype("<u4").tobytes()], pa.binary()),
                     pa.array([c[picked].tobytes()], pa.binary())], ["halves", "counts"])

    found = (merged.where("kind = 0").select("keys", "counts").mapInArrow(frequent, "halves binary, counts binary")
             .where("octet_length(halves) > 0").collect())
    halves = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["halves"], "<u4") for r in found)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], "<i8") for r in found)])
    closing = counts[halves == END >> np.uint64(32)][:1]  # as many texts begin as end
    halves = np.concatenate([halves, np.full(len(closing), START >> np.uint64(32))]).astype(np.uint32)
    often = Often.of(halves, np.concatenate([counts, closing]), n_distinct, s)
    hashes = often.other

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many bits the pairs of each bucket set."""
        for batch in batches:
            sums = [int((often.after(k) + (level(c, s.least, s.base) - 1) * s.upper_hashes).sum())
                    for k, c in zip(_read_keys(batch.column("keys")), _read(batch.column("counts"), "<i8"))]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64())], ["bits"])

    # buckets are alike, with a tenth to spare
    inserted = merged.where("kind = 1").select("keys", "counts").mapInArrow(bits, "bits long").agg(F.sum("bits")).first()[0] or 0
    size = int(max(64, inserted / np.log(2) / 8 / n * 1.1))
    rate = 0.5**hashes  # fewer than half of the bits are set

    def mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Discounted counts of pairs, as the filter will give them, by context word."""
        for batch in batches:
            for k, c in zip(_read_keys(batch.column("keys")), _read(batch.column("counts"), "<i8")):
                if not len(k):
                    continue
                worth = typical(level(c, s.least, s.base), s.least, s.base) - s.discount
                context, number = np.unique(k >> np.uint64(32), return_inverse=True)
                rows = [(b, _packed_keys(x), _packed(y)) for b, x, y in _split(
                    bucket_of(context, n), n, context, np.bincount(number, worth))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([2] * len(rows), pa.int32()),
                     pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    ["bucket", "kind", "keys", "counts"])

    pair_counts = merged.where("kind = 1").select("bucket", "keys", "counts")
    kept = pair_counts.select("keys", "counts").mapInArrow(mass, "bucket int, kind int, keys binary, counts binary")
    words = stage(merged.where("kind = 0").select("bucket", "kind", "keys", "counts").unionByName(kept), "words")
    return Model(words, pair_counts, size, hashes, rate, n, n_tokens, n_distinct, often)


def filter_parts(model: Model, settings: Settings = Settings()) -> Iterator[Filter]:
    """The filter, in parts of at most `part_bytes` (or one segment): at any size, all pairs are in."""
    s, size, hashes, often = settings, model.segment_bytes, model.hashes, model.often

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, k, c in zip(batch.column("bucket").to_pylist(), _read_keys(batch.column("keys")), _read(batch.column("counts"), "<i8")):
                raw = Filter.segment(k, level(c, s.least, s.base), often.after(k), size, s.upper_hashes)
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([raw], pa.binary())], ["bucket", "bits"])

    step = model.part_buckets(s.part_bytes)
    for first in range(0, model.buckets, step):
        segments = np.zeros((min(step, model.buckets - first), size), np.uint8)
        own = model.pairs.where(F.col("bucket").between(first, first + len(segments) - 1))
        for r in own.mapInArrow(build, "bucket int, bits binary").toLocalIterator():
            segments[r["bucket"] - first] = np.frombuffer(r["bits"], np.uint8)
        yield Filter(segments, hashes, first, model.buckets, often, s.upper_hashes)


def _blocks(docs: DataFrame, s: Settings) -> DataFrame:
    """Some `block_bytes` of texts a row: `words`, the distinct ones in order, the number among
    them of each token, and each text's doc_id and number of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in texts.slices(batch, "text"):
                if part.num_rows:
                    held.append((part.column("doc_id"), *tokens(part.column("text"))))
                size += part.column("text").nbytes
                if held and size >= s.block_bytes:
                    yield packed(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield packed(block, held)

    def packed(block: int, held: list) -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        words, numbers = np.unique(np.concatenate([np.array([START], np.uint64), *(h[1] for h in held)]), return_inverse=True)
        sizes = np.concatenate([np.diff(h[2]) for h in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             *(pa.array([x], pa.binary()) for x in (
                 _packed(sizes.astype("<u4")), _packed_keys(words), _packed(numbers[1:].astype("<u4"))))],
            ["block", "doc_id", "sizes", "words", "numbers"])

    return docs.mapInArrow(run, "block long, doc_id array<long>, sizes binary, words binary, numbers binary")


@dataclasses.dataclass
class Block:
    """A row of `_blocks`: its tokens, and its distinct pairs as numbers of two words."""

    words: np.ndarray
    numbers: np.ndarray
    at: np.ndarray
    pair: np.ndarray  # the number of the pair that ends at each token
    before: np.ndarray
    after: np.ndarray

    @staticmethod
    def each(rows: pa.RecordBatch | pa.Table) -> Iterator[Block]:
        for sizes, words, numbers in zip(
                _read(rows.column("sizes"), "<u4"), _read_keys(rows.column("words")), _read(rows.column("numbers"), "<u4")):
            at = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            numbers = numbers.astype(np.int64)
            code = shifted(numbers, at, np.searchsorted(words, START)) * len(words) + numbers
            # Asked for the inverse, `unique` sorts; without, it fills a hash table, which is many times slower.
            distinct, pair = np.unique(code, return_inverse=True)
            before = distinct // len(words)
            yield Block(words, numbers, at, pair, before, distinct - before * len(words))

    def keys(self) -> np.ndarray:
        return pair_keys(self.words[self.before], self.words[self.after])


def _levels(blocks: DataFrame, model: Model, s: Settings) -> DataFrame:
    """`block`, `part`, `levels`: what each part of the filter holds of a block's distinct pairs.

    The pairs are staged by part, so all parts together probe each of them once; a part is
    broadcast, probed and let go of, with its staged pairs, before the next is made.
    """
    spark, n, step = blocks.sparkSession, model.buckets, model.part_buckets(s.part_bytes)
    parts = -(-n // step)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own in zip(batch.column("block").to_pylist(), Block.each(batch)):
                keys = own.keys()
                out = [(part, _packed_keys(k)) for part, k in _split(pair_bucket(keys, n) // step, parts, keys)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(out), pa.int64()), pa.array([r[1] for r in out], pa.binary()),
                     pa.array([r[0] for r in out], pa.int32())], ["block", "keys", "part"])

    asked = "block long, keys binary, part int"
    keys_path, levels_path = new_path(spark, "pairs"), new_path(spark, "levels")
    blocks.select("block", "sizes", "words", "numbers").mapInArrow(ask, asked).write.partitionBy("part").parquet(keys_path)
    keys = spark.read.schema(asked).parquet(keys_path)
    for number, part in enumerate(filter_parts(model, s)):
        sent = spark.sparkContext.broadcast(
            (part.segments, part.hashes, part.first, part.buckets, part.often, part.upper))
        del part

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = Filter(*sent.value)
            for batch in batches:
                found = [_packed(own.levels(k).astype(np.uint8)) for k in _read_keys(batch.column("keys"))]
                yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(found, pa.binary())], ["block", "levels"])

        (keys.where(F.col("part") == number).select("block", "keys").mapInArrow(probe, "block long, levels binary")
         .write.parquet(f"{levels_path}/part={number}"))
        sent.destroy()  # with the driver's copy
        files, probed = hadoop_path(spark, f"{keys_path}/part={number}")
        files.delete(probed, True)  # its levels are stored, and no later step reads its pairs
    return spark.read.schema("block long, levels binary, part int").parquet(levels_path)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """Scores of whole texts: `doc_id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    One row per row of docs (`doc_id`, `text`; others are left aside). A null or empty text
    is its closing token. Both scores are sums of log10 probabilities: `base_score` of words
    alone, add-one smoothed, and `score` of words after words.

    Exact word counts are too many to send everywhere: texts are taken in blocks, the
    distinct words of a block ask their bucket, and the answers, in the order of the words
    and without them, meet the block again. So do the levels of its distinct pairs.
    """
    s = settings
    n, n_tokens, n_distinct = model.buckets, model.tokens, model.distinct
    step = model.part_buckets(s.part_bytes)
    gain_unseen = n_distinct * (s.least - s.discount)  # of all unseen pairs after a word, if they passed
    often = docs.sparkSession.sparkContext.broadcast(model.often)
    blocks = stage(_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), s), "blocks")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, words in zip(batch.column("block").to_pylist(), _read_keys(batch.column("words"))):
                out = [(bucket, _packed_keys(k)) for bucket, k in _split(bucket_of(words >> np.uint64(32), n), n, words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b] * len(out), pa.int64()), pa.array([r[0] for r in out], pa.int32()),
                     pa.array([r[1] for r in out], pa.binary())], ["block", "bucket", "keys"])

    def answer(asked: pa.Table, words: pa.Table) -> pa.Table:
        kind = words.column("kind").to_numpy() if words.num_rows else np.zeros(0, np.int64)
        raw = list(_read_keys(words.column("keys"))) if words.num_rows else []
        counts = [x.as_buffer() for x in words.column("counts")] if words.num_rows else []
        single = [(k, _unpacked(c, "<i8")) for t, k, c in zip(kind, raw, counts) if t == 0]
        after = [(k, _unpacked(c, "<f8")) for t, k, c in zip(kind, raw, counts) if t == 2]
        none = np.zeros(0, np.uint64)
        known, times = _merge([none, *(k for k, _ in single)], [np.zeros(0, np.int64), *(c for _, c in single)])
        context, mass = _merge([none, *(k for k, _ in after)], [np.zeros(0), *(c for _, c in after)])
        out = []
        for k in _read_keys(asked.column("keys")) if asked.num_rows else []:
            out.append((_packed(_look(known, times, k).astype("<i8")),
                        _packed(_look(context, mass, k >> np.uint64(32)).astype("<f4"))))
        return pa.table({
            **{c: asked.column(c).cast(t) if asked.num_rows else pa.array([], t)
               for c, t in (("block", pa.int64()), ("bucket", pa.int32()))},
            **{c: pa.array([r[i] for r in out], pa.binary()) for i, c in enumerate(("counts", "mass"))}})

    def judge(rows: pa.Table, told: pa.Table) -> pa.Table:
        own, = Block.each(rows)
        words, keys = own.words, own.keys()
        answers, probed = (told.filter(x) for x in (told.column("levels").is_null(), told.column("levels").is_valid()))
        counts, mass = np.zeros(len(words), np.int64), np.zeros(len(words))
        by_bucket = dict(zip(answers.column("bucket").to_pylist(),
                             zip(_read(answers.column("counts"), "<i8"), _read(answers.column("mass"), "<f4"))))
        for b, places in _split(bucket_of(words >> np.uint64(32), n), n, np.arange(len(words))):
            counts[places], mass[places] = by_bucket[b]
        found = np.zeros(len(keys), np.int64)
        by_part = dict(zip(probed.column("bucket").to_pylist(), _read(probed.column("levels"), "u1")))
        for part, places in _split(pair_bucket(keys, n) // step, -(-n // step), np.arange(len(keys))):
            found[places] = by_part[part]
        found = believed(found, s.least, s.base)
        seen = counts.astype(float)
        seen[words == START] = _look(words, counts, np.array([END], np.uint64))  # as many texts begin as end
        single = (counts + 1.0) / (n_tokens + 1.0 * (n_distinct + 1))
        gain = np.where(found > 0, typical(np.maximum(found, 1), s.least, s.base) - s.discount, 0.0)
        c_before = seen[own.before]
        whole = np.maximum(c_before, 1.0)
        kept = np.minimum(mass[own.before] / whole, 0.999)
        unseen = gain_unseen * 0.5 ** often.value.after(keys).astype(float)
        rest = np.maximum(1 - kept - np.minimum(unseen / whole, kept), 1e-9)
        alone = single[own.after]
        joint = np.log10(np.where(c_before > 0, np.minimum(gain / whole, kept) + rest * alone, alone))
        return pa.table({
            "doc_id": rows.column("doc_id").combine_chunks().flatten(), "n_tokens": np.diff(own.at),
            "n_known": texts.row_sums((counts > 0)[own.numbers].astype(np.int64), own.at),
            "train_tokens": np.full(len(own.at) - 1, n_tokens, np.int64),
            "base_score": np.add.reduceat(np.log10(single)[own.numbers], own.at[:-1]),
            "score": np.add.reduceat(joint[own.pair], own.at[:-1])})

    asked = blocks.select("block", "words").mapInArrow(ask, "block long, bucket int, keys binary")
    answers = asked.groupBy("bucket").cogroup(model.words.groupBy("bucket")).applyInArrow(
        answer, "block long, bucket int, counts binary, mass binary")
    told = answers.withColumn("levels", F.lit(None).cast("binary")).unionByName(
        _levels(blocks, model, s).select("block", F.col("part").alias("bucket"), "levels"), allowMissingColumns=True)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        judge, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key, or 0."""
    if not len(keys):
        return np.zeros(len(asked), values.dtype)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[place] == asked, values[place], 0)
