"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A text region within k edits of a window of n bytes shares at least n - q + 1 - k * q of its
q-grams, all near one diagonal. Documents are first thinned to regions dense enough in
benchmark q-grams of any kind; there, shared q-grams are counted per item in overlapping
bands of diagonals, then for every window of the item, and windows that meet the bound are
aligned with their band. Letter case (A-Z) and the amount of white space do not count.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm import texts

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[texts.SPACES] = 32
Q = 8  # bytes of a q-gram: one 64-bit number
CELLS = 1 << 20  # window counts held at a time


@dataclasses.dataclass(frozen=True)
class Settings:
    """Windows of `window` bytes, at every byte of an item, may differ by `rate` of their length.

    A shorter item is one window; one shorter than a q-gram is never found. The benchmark is
    sent to tasks in passes of about `pass_bytes`, however large it is.
    """

    window: int = 100
    rate: float = 0.08
    pass_bytes: int = 1 << 20


def normal(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with single blanks, each row's offsets, and where each byte was."""
    solid = ~texts.IS_SPACE[data]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    keep[heads] = solid[heads]
    place = np.flatnonzero(keep)
    return LOWER[data[place]], np.searchsorted(place, at), place


def grams(chars: np.ndarray) -> np.ndarray:
    """The q-gram at each byte as a number; the last ones run into zeros."""
    padded = np.concatenate((chars, np.zeros(2 * Q, np.uint8)))
    out = np.empty(len(chars), np.uint64)
    for r in range(min(Q, len(chars))):
        n = len(out[r::Q])
        out[r::Q] = np.frombuffer(padded[r : r + Q * n].tobytes(), "<u8")
    return out


class Windows:
    """Windows of benchmark items, and where each q-gram occurs in the items.

    Windows are numbered by item and place: those of item `i` are `first_window[i]` and on, one
    at each byte from the item's first. `item` of a window counts the items that are long enough.
    """

    def __init__(self, items: list[tuple[int, str]], s: Settings):
        kept, owner = [], []
        for item, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            chars, _, _ = normal(data, np.array([0, len(data)]))
            if len(chars) and chars[-1] == 32:
                chars = chars[:-1]
            if len(chars) >= Q:
                kept.append(chars)
                owner.append(item)
        length = np.array([len(c) for c in kept], np.int64)
        self.item_size = np.minimum(s.window, length)  # bytes of each window of an item
        self.places = length - self.item_size + 1  # windows of each item
        self.first_window = np.concatenate(([0], np.cumsum(self.places)))
        self.item = np.repeat(np.arange(len(kept)), self.places)
        self.owner = [owner[i] for i in self.item]
        self.size = self.item_size[self.item]
        budget = np.minimum((s.rate * self.item_size).astype(np.int64), (self.item_size - Q) // Q)
        self.edits, self.need = budget[self.item], (self.item_size - Q + 1 - budget * Q)[self.item]
        self.step = int(max(1, self.edits.max(initial=0)))
        if not kept:
            return
        self.text = np.concatenate(kept)
        at = np.cumsum(length) - length
        self.window_at = np.repeat(at - self.first_window[:-1], self.places) + np.arange(len(self.item))
        all_grams = np.concatenate([grams(c)[: len(c) - Q + 1] for c in kept])
        counts = length - Q + 1
        item = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(all_grams, kind="stable")
        self.known, first = np.unique(all_grams[order], return_index=True)
        self.first = np.append(first, len(order))
        self.gram_item, self.offset = item[order], offset[order]
        self.longest = int(length.max())
        self.table = np.zeros(1 << 22, bool)
        self.table[self._slot(self.known)] = True

    @functools.cached_property
    def chars(self) -> list[np.ndarray]:
        return [self.text[a : a + n] for a, n in zip(self.window_at, self.size)]

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def find(self, column: pa.Array):
        """Rows, windows, edits and byte ranges (of the text as given) of all matches."""
        none = [np.zeros(0, np.int64)] * 5
        data, at = texts.text_bytes(column)
        chars, at, place = normal(data, at)
        if not self.owner or len(chars) < Q:
            return none
        values = grams(chars)
        maybe = np.flatnonzero(self.table[self._slot(values)])
        number = np.minimum(np.searchsorted(self.known, values[maybe]), len(self.known) - 1)
        true = self.known[number] == values[maybe]
        hit, number = maybe[true], number[true]
        row = np.searchsorted(at, hit, "right") - 1
        inside = hit + Q <= at[row + 1]
        hit, number, row = hit[inside], number[inside], row[inside]
        # dense regions: enough hits of any window within the longest stretch that a match can take
        span = int(self.size.max() - Q + 1 + self.step)
        upto = np.searchsorted(hit, hit + span)
        dense = np.flatnonzero(upto - np.arange(len(hit)) >= self.need.min())
        if not len(dense):
            return none
        edges = np.zeros(len(hit) + 1, np.int64)
        np.add.at(edges, dense, 1)
        np.add.at(edges, upto[dense], -1)
        live = np.cumsum(edges[:-1]) > 0
        hit, number, row = hit[live], number[live], row[live]
        # every place of the q-gram in an item, in the two bands that hold its diagonal
        times = self.first[number + 1] - self.first[number]
        entry = np.repeat(self.first[number], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, offset = self.gram_item[entry], self.offset[entry]
        band = (np.repeat(hit, times) - offset + self.longest) // self.step
        row, window, band = self._candidates(np.repeat(row, times), item, offset, band)
        low = band * self.step - self.longest
        edits, end = self._align(chars, at, row, window, low)
        match = edits <= self.edits[window]
        row, window, edits, end = row[match], window[match], edits[match], end[match]
        start = np.maximum(end - self.size[window], at[row])
        text_at = texts.text_bytes(column)[1]
        first, last = place[np.minimum(start, len(place) - 1)], place[end - 1] + 1
        return row, window, edits, first - text_at[row], last - text_at[row]

    def _candidates(self, row, item, offset, band):
        """Rows, windows and bands in which as many q-grams are shared as the window's bound asks."""
        row, item, offset = np.tile(row, 2), np.tile(item, 2), np.tile(offset, 2)
        band = np.concatenate((band, band - 1))
        order = np.lexsort((band, item, row))
        row, item, offset, band = row[order], item[order], offset[order], band[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(row)))
        group = np.flatnonzero(count >= self.need[self.first_window[item[begin]]])
        out = []
        # groups in parts: a number for each window of a group's item
        cells = np.cumsum(self.places[item[begin[group]]] + 1)
        for own in np.split(group, np.searchsorted(cells, np.arange(CELLS, cells[-1], CELLS))) if len(group) else []:
            if not len(own):
                continue
            head = begin[own]
            places = self.places[item[head]]
            at = np.cumsum(places + 1) - (places + 1)
            part = np.repeat(np.arange(len(own)), count[own])
            hits = np.repeat(head, count[own]) + np.arange(len(part)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
            reach = self.item_size[item[hits]] - Q  # a window that begins at most so far before holds the q-gram
            change = np.zeros(int((places + 1).sum()), np.int64)
            np.add.at(change, at[part] + np.maximum(offset[hits] - reach, 0), 1)
            np.add.at(change, at[part] + np.minimum(offset[hits] + 1, places[part]), -1)
            held = np.cumsum(change)  # each group adds up to 0
            need = np.repeat(self.need[self.first_window[item[head]]], places + 1)
            found = np.flatnonzero(held >= need)
            part = np.searchsorted(at, found, "right") - 1
            # a window that begins at byte p of its item lies on the diagonals of the item, moved by p
            window = self.first_window[item[head[part]]] + found - at[part]
            out.append((row[head[part]], window, band[head[part]]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def _align(self, chars, at, row, window, low):
        """Least edits of each window against the text on its band, and where that match ends.

        One dynamic programme for all candidates of a size: a row per window byte, a
        column per diagonal of the band widened by the edit budget on both sides.
        """
        edits, end = np.full(len(row), 1 << 20), np.zeros(len(row), np.int64)
        width = 4 * self.step + 1
        slope = np.arange(width)
        for size in np.unique(self.size[window]) if len(window) else []:
            for own in np.array_split(np.flatnonzero(self.size[window] == size), 1 + len(window) // 4096):
                if not len(own):
                    continue
                pattern = self.text[self.window_at[window[own]][:, None] + np.arange(size)]
                begin = window[own] - self.first_window[self.item[window[own]]]  # the window's place in its item
                left = low[own] + begin - self.step  # text place of diagonal 0
                lo, hi = at[row[own]][:, None], at[row[own] + 1][:, None]
                cost = np.zeros((len(own), width), np.int32)
                for i in range(int(size)):
                    where = left[:, None] + i + slope
                    there = (where >= lo) & (where < hi)
                    char = chars[np.clip(where, 0, len(chars) - 1)]
                    # same diagonal: match or replace; next diagonal: window byte missing in the text
                    change = cost + np.where(there & (char == pattern[:, i : i + 1]), 0, 1)
                    miss = np.concatenate((cost[:, 1:], np.full((len(own), 1), 1 << 20, np.int32)), axis=1) + 1
                    cost = np.minimum(change, miss)
                    # previous diagonal: text byte more
                    cost = np.minimum.accumulate(cost - slope, axis=1) + slope
                best = cost.argmin(axis=1)
                edits[own] = cost[np.arange(len(own)), best]
                end[own] = np.clip(left + size + best, lo[:, 0] + 1, hi[:, 0])
        return edits, end


def _passes(benchmark: DataFrame, s: Settings) -> Iterator[list[tuple[int, str]]]:
    """Items in parts of about `pass_bytes`, each small enough for the driver and every task."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // s.pass_bytes))
    for p in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == p)
        yield [(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Benchmark items that occur in documents, wholly or by a window of theirs.

    docs: `doc_id`, `text`; benchmark: `item_id`, `text`; other columns are left aside.
    Returns per row of docs and item found: `doc_id`, `item_id`, `windows` found, the least
    `edits` of one, and the byte range `first` to `last` of the text (UTF-8) that they
    span, exact to the edit budget. Null or empty texts, and items without text, match
    nothing. Repeated rows give repeated results. Whole texts are read, in one scan a pass.
    """
    schema = "doc_id long, item_id long, windows long, edits long, first long, last long"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for items in _passes(benchmark, settings):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            windows = Windows(items, settings)
            owner = np.array(windows.owner, object)
            for batch in batches:
                for part in texts.slices(batch, "text"):
                    row, window, edits, first, last = windows.find(part.column("text"))
                    groups: dict = {}
                    for r, w, e, a, b in zip(row.tolist(), window.tolist(), edits.tolist(), first.tolist(), last.tolist()):
                        g = groups.setdefault((r, owner[w]), [set(), e, a, b])
                        g[0].add(w)
                        g[1:] = min(g[1], e), min(g[2], a), max(g[3], b)
                    rows = [(r, i, len(w), e, a, b) for (r, i), (w, e, a, b) in groups.items()]
                    ids = part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *[pa.array([r[c] for r in rows], pa.int64()) for c in range(1, 6)]],
                        ["doc_id", "item_id", "windows", "edits", "first", "last"])

        part = docs.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_passages(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, all columns as they are, whose `text` holds no benchmark passage."""
    for items in _passes(benchmark, settings):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            windows = Windows(items, settings)
            for batch in batches:
                for part in texts.slices(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[windows.find(part.column("text"))[0]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
