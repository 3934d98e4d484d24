"""Token sequences of fixed length, packed by bounded-space best-fit.

Every packer holds a fixed number of open bins. An integer serves as the bit set of the
free spaces among them: the lowest set bit at or above a piece's length is the tightest
bin that takes it. With all bins open and none that fits, the fullest one closes first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from skyledger.llm import texts
from skyledger.session import stage

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 1024
PIECES_PER_PACKER = 100_000
KNOWN_WORDS = 300_000  # cached words per worker; beyond, the cache starts anew

# words that the tokenizer's own rules split into letters, and then marks: no apostrophe, Latin-1 only
PLAIN = re.compile(r"([A-Za-zß-öø-ÿÀ-ÖØ-Þ]*)([!\"#$%&(-/:-@\[-`{-~]*)")


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins for bytes as byte-level tokenizers write them: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """Token ids of texts, as little-endian 32-bit words, through a cache of blank-separated words.

    The tokenizer must drop white space and never join across it, so that a text's ids are
    those of its words in a row. Words of Latin-1 letters and marks go straight to the
    merge model, others through the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.letters = byte_alphabet()
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = "".join(self.letters[b] for b in part.encode())
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
            self.parts[part] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        plain = PLAIN.fullmatch(text)
        if plain:
            return self._part(plain[1].lower()) + self._part(plain[2])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        if len(self.parts) > KNOWN_WORDS:
            self.parts = {"": b""}
        known, split = self.known, text.encode().split()
        try:
            return b"".join([known[w] for w in split])
        except KeyError:
            for w in split:
                if w not in known:
                    known[w] = self._word(w)
            return b"".join([known[w] for w in split])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents as token ids with a closing id 0, cut only where longer than `capacity`.

    docs: `doc_id`, `text` (null is empty: the closing id alone); other columns are left
    aside. Per piece: `doc_id`, `piece` from 0, `start`, `length`, `ids_crc32`, and with
    `with_ids` the `ids` as little-endian 32-bit words.
    """
    size = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = texts.once(("words", tokenizer), lambda: WordEncoder(tokenizer))
        for batch in batches:
            doc, number, length, crc, ids = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = own.encode(text or "") + END_ID.to_bytes(4, "little")
                for i in range(0, len(raw), size):
                    cut = raw[i : i + size]
                    doc.append(doc_id)
                    number.append(i // size)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(cut)
            number = np.array(number, np.int32)
            columns = [pa.array(doc, pa.int64()), pa.array(number), pa.array(number.astype(np.int64) * capacity),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, schema)


class Bins:
    """Open bins by free space; `put` gives a piece's bin number and its place there."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f: some open bin has f ids free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = self.open = 0

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            number, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            if self.open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            if not self.bins[left]:
                self.free |= 1 << left
            self.bins[left].append(number)
            self.open += 1
        return number, self.capacity - space




def pack(cut: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         pieces_per_packer: int = PIECES_PER_PACKER) -> DataFrame:
    """`sequence_id` and `offset` for rows with a `length` of at most `capacity`.

    `cut` is read more than once, so give a written table. Rows are dealt by a hash of all
    columns to packers of about `pieces_per_packer` rows, each of which works alone and in
    a fixed order, so a repeated task gives the same places. Only `open_bins` bins per
    packer are held. Rows of an empty table give an empty result.
    """
    packers = max(1, -(-cut.count() // pieces_per_packer))
    names = cut.columns
    order = F.xxhash64(*names)
    schema = cut.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [bins.put(x) for x in batch.column("length").to_pylist()]
            number = np.array([x for x, _ in places], np.int64)
            offset = np.array([x for _, x in places], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number + base), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    dealt = cut.repartition(packers, order).sortWithinPartitions(order, *[c for c, t in cut.dtypes if t != "binary"])
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most `capacity` ids."""
    return pack(stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)
