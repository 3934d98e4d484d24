"""Words, hashes and row slices of Arrow text columns, without a Python loop per word."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handed to numpy at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 18

# The white space that separates words (blank and 0x09 to 0x0D).
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[SPACES] = True


def once(key: tuple, make: Callable):
    """An object made once per Python process and key, however often Spark loads the asking function."""
    held = sys.__dict__.setdefault("skyledger_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(n: int, seed: int) -> np.ndarray:
    """`n` fixed odd multipliers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed * 0x51ED2701 + 1)) | np.uint64(1)


BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
BYTE_KEYS[65:91] = BYTE_KEYS[97:123]  # A-Z hash as a-z
_PLACE_KEYS = keys(256, 1)


def place_keys(n: int) -> np.ndarray:
    return _PLACE_KEYS[:n] if n <= len(_PLACE_KEYS) else keys(n, 1)


def uniform(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and where each row begins (n + 1 offsets); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in order, in slices of at most `limit` bytes of `column`."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, size in enumerate(sizes):
        if total + size > limit and row > begin:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word; words never cross a row."""
    solid = ~IS_SPACE[data]
    if not solid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = at[:-1][(at[:-1] < at[1:])]
    first[heads] = solid[heads]
    begin = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    return begin, np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A-Z read as a-z. Spans are not empty and do not overlap."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    sizes = end - begin
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    if len(place) == len(data):
        chars = data
    else:
        chars = data[place + np.repeat(begin, sizes)]
    terms = BYTE_KEYS[chars] * place_keys(int(sizes.max()))[place]
    return mix(np.add.reduceat(terms, at) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each row's words begin (n + 1 offsets)."""
    begin, end = words(data, at)
    return hash_spans(data, begin, end), np.searchsorted(begin, at)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of `size`-word shingles per row, and where each row's begin.

    A row with fewer words has one shingle, the whole sequence; one without words has none.
    """
    data, at = text_bytes(column)
    hashes, starts = hashed_words(data, at)
    counts = np.diff(starts)
    factors = keys(size, 2)
    full = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    out_at = np.concatenate(([0], np.cumsum(full)))
    row = np.repeat(np.arange(len(counts)), full)
    first = starts[:-1][row] + np.arange(out_at[-1]) - out_at[:-1][row]
    used = np.minimum(counts, size)[row]
    total = used.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    padded = np.concatenate((hashes, np.zeros(size, np.uint64)))
    for j in range(size):
        total += np.where(j < used, padded[first + j] * factors[j], np.uint64(0))
    total = mix(total)
    for a, b in zip(out_at[:-1], out_at[1:]):
        total[a:b].sort()
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (row[1:] != row[:-1])
    sizes = np.bincount(row[fresh], minlength=len(counts)) if len(row) else np.zeros(len(counts), np.int64)
    return total[fresh], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; `at` has n + 1 offsets, and rows may be empty."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]
