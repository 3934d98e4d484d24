"""SentencePiece encoding and decoding in rounds of array operations.

Texts become one flat array of characters, cut into words wherever two neighbours never
stand side by side within a piece, so no merge crosses a cut. Each round finds the best
ranked pair of every word, merges its leftmost places at once, and drops the words that
have no pair left. Equal words are merged once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from skyledger.llm import texts

BLANK = "▁"  # stands for a blank within pieces
# What the library shows for an unknown id, and for a byte that is no character.
UNKNOWN_SHOWN = " ⁇ ".encode()
NO_CHARACTER = "�".encode()

# Characters handled at a time; longer texts are taken in stretches.
CHUNK = 1 << 21
NONE = np.int32(np.iinfo(np.int32).max)

# Texts that tell whether a model changes characters or blanks before it merges.
PROBES = ["", " ", "a  b ", "ﬁ Ａ ½\tx\r\n\ny", "éé 　  \U0001f642​", "▁<s></s><0x0A>"]


class Pieces:
    """The tables of a byte-fallback BPE model without text normalisation.

    Symbols are ids of pieces; then come characters that occur within pieces but are none
    themselves; a character no piece holds has a number beyond these and merges with none.
    """

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        kinds = [(model.is_control(i), model.is_unknown(i), model.is_byte(i), model.is_unused(i)) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not any(kinds[i])]
        number = {names[i]: i for i in normal}
        self.end = model.eos_id()

        chars = sorted({c for i in normal for c in names[i]})
        for c in chars:
            number.setdefault(c, len(number) - len(normal) + n)
        self.symbols = n + len(number) - len(normal)
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.symbols
        self.of_char[[ord(c) for c in chars]] = [number[c] for c in chars]

        # neighbours within some piece
        self.place = np.zeros(0x110000, np.int32)
        self.place[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        pairs = {(a, b) for i in normal for a, b in zip(names[i], names[i][1:])}
        if pairs:
            self.beside[tuple(np.array([[self.place[ord(c)] for c in side] for side in zip(*pairs)]))] = True

        # every way to make a piece of two symbols; equal scores share a rank
        made = {}
        for i in normal:
            for cut in range(1, len(names[i])):
                left, right = number.get(names[i][:cut]), number.get(names[i][cut:])
                if left is not None and right is not None:
                    made[left * self.symbols + right] = i
        self.keys = np.array(sorted(made), np.int64)
        self.makes = np.array([made[k] for k in self.keys.tolist()], np.int32)
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)

        self.byte_ids = np.full(256, -1, np.int32)
        shown = [b""] * n
        for i, (control, unknown, byte, _) in enumerate(kinds):
            if byte:
                value = int(names[i][1:-1], 16)
                self.byte_ids[value] = i
                shown[i] = bytes([value])
            elif unknown:
                shown[i] = UNKNOWN_SHOWN
            elif not control:
                shown[i] = names[i].replace(BLANK, " ").encode()
        self.control = np.array([k[0] for k in kinds])
        self.byte = np.array([k[2] for k in kinds])
        self.leads = np.array([not any(k[:3]) and p.startswith(BLANK) for k, p in zip(kinds, names)])
        self.shown_size = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.concatenate(([0], np.cumsum(self.shown_size)[:-1]))
        self.shown = np.frombuffer(b"".join(shown), np.uint8)

        if any(k[3] for k in kinds) or (self.byte_ids < 0).any():
            raise ValueError(f"{path} has unused pieces or no byte pieces")
        for probe, (flat, at) in zip(PROBES, (self.encode([p]) for p in PROBES)):
            if flat.tolist() != model.encode(probe, add_eos=True) or at[-1] != len(flat):
                raise ValueError(f"{path} is no BPE model that reads texts as they are")

    # --- encoding

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece two symbols make, or -1."""
        asked = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.makes[at], np.int32(-1)) if len(self.keys) else np.full(len(asked), -1, np.int32)

    def ranks(self, pieces: np.ndarray) -> np.ndarray:
        return np.where(pieces >= 0, self.rank[pieces], NONE)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each word after all merges; `word` numbers the words, in order, none empty.

        The order is the library's: the best rank in the word first, the leftmost of equals.
        Places of one rank may merge together as long as no merge makes a pair that has to
        come before the next place; such a word goes on in the next round.
        """
        done_symbols, done_words = [], []
        while len(symbols):
            makes = np.full(len(symbols), -1, np.int32)
            inner = np.flatnonzero(word[:-1] == word[1:])
            makes[inner] = self.pair(symbols[inner], symbols[inner + 1])
            rank = self.ranks(makes)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            going = best != NONE
            done_symbols.append(symbols[~going])
            done_words.append(word[~going])
            symbols, word, makes, rank, best = (x[going] for x in (symbols, word, makes, rank, best))
            if not len(symbols):
                break
            hit = rank == best
            index = np.arange(len(symbols))
            before = np.concatenate(([False], hit[:-1]))
            run = np.maximum.accumulate(np.where(hit & ~before, index, 0))
            at = np.flatnonzero(hit & ((index - run) % 2 == 0))
            at = at[self._until_better(symbols, word, makes, rank, at)]
            symbols[at] = makes[at]
            left = np.ones(len(symbols), bool)
            left[at + 1] = False
            symbols, word = symbols[left], word[left]
        symbols, word = np.concatenate([*done_symbols, np.zeros(0, np.int32)]), np.concatenate([*done_words, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _until_better(self, symbols, word, makes, rank, at) -> np.ndarray:
        """Of the places of each word, those up to the first whose merge makes a pair at least as good."""
        own = word[at]
        several = np.zeros(len(at), bool)
        several[1:] = own[1:] == own[:-1]
        several[:-1] |= several[1:]
        keep = np.ones(len(at), bool)
        picked = np.flatnonzero(several)
        if not len(picked):
            return keep
        p, w = at[picked], own[picked]
        new = makes[p]
        taken = np.zeros(len(symbols), bool)
        taken[at] = True
        after_merge = (p >= 2) & taken[p - 2] & (word[p - 2] == w)
        left = np.where(after_merge, makes[p - 2], symbols[p - 1])
        right_at = np.minimum(p + 2, len(symbols) - 1)
        has_left = (p >= 1) & (word[p - 1] == w)
        has_right = (p + 2 < len(symbols)) & (word[right_at] == w)
        better = np.where(has_left, self.ranks(self.pair(left, new)), NONE) <= rank[p]
        better |= np.where(has_right, self.ranks(self.pair(new, symbols[right_at])), NONE) <= rank[p]
        earlier = np.cumsum(better) - better
        first = np.concatenate(([True], w[1:] != w[:-1]))
        base = np.maximum.accumulate(np.where(first, earlier, 0))
        keep[picked] = earlier == base
        return keep

    def words(self, chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct words, where each word's begin, and the word at each place."""
        data = chars.astype("<u4", copy=False)
        at = np.append(starts, len(chars)).astype(np.int64) * 4
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        kept = coded.dictionary
        ends = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset : kept.offset + len(kept) + 1] // 4
        letters = np.frombuffer(kept.buffers()[2], "<u4")[ends[0] : ends[-1]]
        word = np.repeat(np.arange(len(kept)), np.diff(ends))
        symbols, word = self.merge(self.of_char[letters], word)
        sizes = np.bincount(word, minlength=len(kept))
        strange = np.flatnonzero(symbols >= len(self.rank))
        if len(strange):  # a character that is no piece is spelt by its bytes
            odd = np.unique(letters)
            odd = odd[self.of_char[odd] >= len(self.rank)]
            spelt = {s: self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))]
                     for c, s in zip(odd.tolist(), self.of_char[odd].tolist())}
            parts, last, grown = [], 0, np.ones(len(symbols), np.int64)
            for place in strange.tolist():
                own = spelt[int(symbols[place])]
                parts += [symbols[last:place], own]
                grown[place], last = len(own), place + 1
            symbols = np.concatenate([*parts, symbols[last:]])
            sizes = np.bincount(word, grown, minlength=len(kept)).astype(np.int64)
        return symbols, np.concatenate(([0], np.cumsum(sizes))), np.asarray(coded.indices)

    def _spans(self, parts: list[str], last: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of whole texts, or of a text's stretch, where each part's begin, and characters left for later.

        With `last` false the only part may go on, so its last word is left.
        """
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        edges = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        cut = np.ones(len(chars), bool)
        place = self.place[chars]
        cut[1:] = ~self.beside[place[:-1], place[1:]]
        cut[edges[:-1][edges[:-1] < len(chars)]] = True
        starts = np.flatnonzero(cut)
        left = 0
        if not last:
            left = len(chars) - int(starts[-1])
            chars, starts = chars[: len(chars) - left], starts[:-1]
            edges = np.minimum(edges, len(chars))
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(parts) + 1, np.int64), left
        ids, word_at, words = self.words(chars, starts)
        sizes = np.diff(word_at)[words]
        out_at = np.concatenate(([0], np.cumsum(sizes)))
        source = np.arange(out_at[-1]) + np.repeat(word_at[:-1][words] - out_at[:-1], sizes)
        return ids[source], out_at[np.searchsorted(starts, edges)], left

    def encode(self, rows: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, each with the end id, and where each row's begin (n + 1 offsets)."""
        flat, sizes, held, total = [], [], [], 0

        def flush() -> None:
            ids, at, _ = self._spans(held, True)
            grown = np.insert(ids, at[1:], self.end)
            flat.append(grown.astype(np.int32, copy=False))
            sizes.extend((np.diff(at) + 1).tolist())
            held.clear()

        for row in rows:
            row = row or ""
            if len(row) > CHUNK:
                flush()
                total = 0
                own = self._long(row)
                flat.append(own)
                sizes.append(len(own))
                continue
            held.append(BLANK + row.replace(" ", BLANK) if row else "")
            total += len(row)
            if total >= CHUNK:
                flush()
                total = 0
        if held:
            flush()
        at = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
        return np.concatenate([*flat, np.zeros(0, np.int32)]), at

    def _long(self, row: str) -> np.ndarray:
        """One text in stretches; a word that a stretch breaks off opens the next one."""
        out, rest, step, at = [], BLANK, CHUNK, 0
        while at < len(row):
            part = rest + row[at : at + step].replace(" ", BLANK)
            at += step
            ids, _, left = self._spans([part], at >= len(row))
            out.append(ids)
            rest = part[len(part) - left :] if left else ""
            step = max(CHUNK, len(rest))  # a word without end is not read again and again
        return np.concatenate([*out, np.array([self.end], np.int32)])

    # --- decoding

    def decode(self, flat: np.ndarray, at: np.ndarray) -> list[str]:
        """The text of each row of ids (n + 1 offsets)."""
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.rank)):
            raise ValueError("an id is not of this model")
        # the blank before the first text of a row goes; ids that show nothing do not count
        speaking = np.flatnonzero(~self.control[flat])
        first = np.searchsorted(speaking, at[:-1])
        lead = speaking[first[first < len(speaking)]]
        lead = lead[lead < at[1:][first < len(speaking)]]
        lead = lead[self.leads[flat[lead]]]
        size, begin = self.shown_size[flat], self.shown_at[flat]
        size[lead] -= 1
        begin[lead] += 1
        out_at = np.concatenate(([0], np.cumsum(size)))
        data = self.shown[np.arange(out_at[-1]) + np.repeat(begin - out_at[:-1], size)].tobytes()
        # a silent id right after a byte ends a run of bytes, which joined might make a character
        parted = np.flatnonzero(self.control[flat[1:]] & self.byte[flat[:-1]]) + 1
        apart = np.zeros(len(at), bool)
        apart[np.searchsorted(at, parted[parted < len(flat) - 1], side="right") - 1] = True
        edges, out = out_at[at].tolist(), []
        for row, (a, b) in enumerate(zip(edges, edges[1:])):
            try:
                out.append(data[a:b].decode())
                if not apart[row]:
                    continue
                out.pop()
            except UnicodeDecodeError:
                pass
            own = slice(at[row], at[row + 1])
            out.append(self._mended(flat[own], data[a:b], np.cumsum(size[own])))
        return out

    def _mended(self, ids: np.ndarray, data: bytes, ends: np.ndarray) -> str:
        """Runs of byte ids, with a replacement for each byte that is part of no character."""
        out, at = [], 0
        byte = self.byte[ids]
        # neighbours of one kind; ids that show nothing end a run of bytes
        edges = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1], [True])))
        for a, b in zip(edges[:-1], edges[1:]):
            run = data[at : ends[b - 1]]
            at = int(ends[b - 1])
            if not byte[a]:
                out.append(run)
                continue
            i = 0
            while i < len(run):
                size = 1 if run[i] < 0x80 else 2 if run[i] < 0xE0 else 3 if run[i] < 0xF0 else 4
                try:
                    run[i : i + size].decode()
                    out.append(run[i : i + size])
                    i += size
                except UnicodeDecodeError:
                    out.append(NO_CHARACTER)
                    i += 1
        return b"".join(out).decode()


def pieces(path: str) -> Pieces:
    """One per worker process and model file."""
    return texts.once(("pieces", path), lambda: Pieces(path))


def _id_lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(flat, pa.int32())).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """`doc_id` and `ids` (array of int, closed by the end id), one row per row of docs (`doc_id`, `text`).

    A null or empty text is the end id alone; other columns are left aside, repeated rows
    are repeated. A blank goes before every text, as the model asks for. Texts of any
    length are read whole, in stretches that end between words; only a run of characters
    without any cut, such as one letter repeated, is held in one piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for part in texts.slices(batch, "text", CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _id_lists(*own.encode(part.column("text").to_pylist()))], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """`doc_id` and `text` of rows of `doc_id`, `ids`: what the model's library decodes.

    A null array is empty and a null id shows nothing, as the end id does. Bytes that make no character are
    replaced one by one; an id beyond the model is an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            lists = batch.column("ids")
            flat, sizes = [], []
            for ids in lists:
                values = np.zeros(0, np.int32) if ids.values is None else ids.values.fill_null(own.end).to_numpy(zero_copy_only=False)
                flat.append(values)
                sizes.append(len(values))
            at = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
            shown = own.decode(np.concatenate([*flat, np.zeros(0, np.int32)]), at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shown, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """`doc_id`, `ids` as `encode` gives them, and `text` as `decode` gives it of them, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for part in texts.slices(batch, "text", CHUNK):
                flat, at = own.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _id_lists(flat, at), pa.array(own.decode(flat, at), pa.string())],
                    ["doc_id", "ids", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")
