"""Conversations as token ids with a loss mask, assembled from separately encoded segments.

Turns are marked by reserved ids above the vocabulary, which no text encodes to. The same
output shown as text has control strings in their place; in contents these are escaped by a
backslash, so both forms can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from skyledger.llm import texts
from skyledger.llm.packing import byte_alphabet

# What the reserved ids stand for, counted from the size of the vocabulary.
MARKS = ["### System: ", "### User: ", "### Assistant: ", "### ", ": ", " </turn>\n"]
ROLES = {"system": 0, "user": 1, "assistant": 2}
OTHER, ROLE_END, TURN_END = 3, 4, 5
TRAINED = "assistant"

CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")


def escape(text: str, role: bool = False) -> str:
    """A backslash before each control string and backslash; in a role's name before colons too."""
    return (ROLE_CONTROL if role else CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class Codec:
    """Encodes segments with a byte-level tokenizer, and reads ids back."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        back = {c: b for b, c in byte_alphabet().items()}
        self.first = self.tokenizer.get_vocab_size()
        self.bytes: list[bytes] = [b""] * self.first
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        for token, number in self.tokenizer.get_vocab().items():
            if token not in special:
                self.bytes[number] = bytes(back[c] for c in token)

    def encode(self, segments: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode()


def codec(path: str) -> Codec:
    """One per worker process and tokenizer file."""
    return texts.once(("codec", path), lambda: Codec(path))


def format_turns(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row per turn of the formatted conversations, in order within each task.

    turns: `conv_id`, `turn`, `role`, `text`; other columns are left aside, a null role or
    text is empty, rows of a null conv_id are one conversation. Turns go by `turn` (null
    first), then role and text. Returns `conv_id`, `number` of the turn, `token_start` in
    its conversation, `ids` (little-endian 32-bit words) and `mask` (a byte per id, 1 where
    the loss counts: the text of assistant turns).

    Segments are encoded before the shuffle, where rows are. A conversation is then read as
    a sorted stream, and only its running position is kept.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            roles, contents = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            names = own.encode([escape(r, role=True) if r not in ROLES else "" for r in roles])
            bodies = own.encode([escape(x) for x in contents])
            ids, marks = [], []
            for role, name, body in zip(roles, names, bodies):
                head = [own.first + ROLES[role]] if role in ROLES else [own.first + OTHER, *name, own.first + ROLE_END]
                ids.append(np.array([*head, *body, own.first + TURN_END], "<u4").tobytes())
                marks.append([len(head), len(head) + len(body)] if role == TRAINED else [0, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"),
                 pa.array(ids, pa.binary()), pa.array(marks, pa.list_(pa.int64()))],
                ["conv_id", "turn", "role", "ids", "trained"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, at = object(), 0, 0
        for batch in batches:
            numbers, starts, masks = [], [], []
            for conv, ids, (a, b) in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "trained"))):
                if conv != now:
                    now, number, at = conv, 0, 0
                edges = np.zeros(len(ids) // 4 + 1, np.int8)
                edges[a] += 1
                edges[b] -= 1
                masks.append(np.cumsum(edges[:-1]).astype(np.int8).tobytes())
                numbers.append(number)
                starts.append(at)
                number, at = number + 1, at + len(ids) // 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(numbers, pa.int64()), pa.array(starts, pa.int64()),
                 batch.column("ids"), pa.array(masks, pa.binary())],
                ["conv_id", "number", "token_start", "ids", "mask"])

    encoded = rows.mapInArrow(segments, "conv_id long, turn long, role string, ids binary, trained array<long>")
    dealt = encoded.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "ids")
    return dealt.mapInArrow(assemble, "conv_id long, number long, token_start long, ids binary, mask binary")


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation what its token ids and mask say: see the columns of `digests` in the query.

    `formatted` must have each conversation's turns in order within one task, as
    `format_turns` gives them. Texts pass through running digests; no conversation is held.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def turn(own: Codec, ids: np.ndarray, mask: np.ndarray):
        head = ids[0] - own.first
        if head == OTHER:
            cut = int(np.flatnonzero(ids == own.first + ROLE_END)[0])
            shown = own.text(ids[1:cut])
            role = unescape(shown)
            extra = len(MARKS[OTHER]) + len(shown) + len(MARKS[ROLE_END])
        else:
            cut, role, extra = 0, next(r for r, i in ROLES.items() if i == head), len(MARKS[head])
        if ids[-1] != own.first + TURN_END:
            raise ValueError("a turn does not end with its mark")
        body = own.text(ids[cut + 1 : -1])
        trained = unescape(own.text(ids[mask == 1]))
        return role, unescape(body), trained, extra + len(body) + len(MARKS[TURN_END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, state = codec(tokenizer), None, None
        for batch in batches:
            done = []
            for conv, raw, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "mask"))):
                if state is None or conv != now:
                    if state is not None:
                        done.append(finish(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body, trained, shown = turn(own, np.frombuffer(raw, "<u4"), np.frombuffer(mask, np.int8))
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += shown
            yield rows(done)
        if state is not None:
            yield rows([finish(now, state)])

    def finish(conv, state):
        n, all_turns, chars, trained, shown = state
        return conv, n, all_turns.hexdigest(), chars, trained.hexdigest(), shown

    def rows(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in done], kind) for i, kind in enumerate(kinds)], names)

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def render(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """The formatted turns as text: `conv_id`, `number`, `shown`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            shown = [b"".join([own.bytes[i] if i < own.first else MARKS[i - own.first].encode()
                               for i in np.frombuffer(raw, "<u4")]).decode() for raw in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("number"), pa.array(shown, pa.string())], ["conv_id", "number", "shown"])

    return formatted.mapInArrow(run, "conv_id long, number long, shown string")
