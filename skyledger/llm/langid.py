"""Language by compression: the language whose sample text helps zstandard most.

Each language has a raw-content dictionary, plain text of its training documents. A text
is reduced to lower-case letters and cut into stretches that are compressed once with every
dictionary; the language with the smallest sum of sizes wins, and the margin to the next
says how sure that is. A narrow margin rejects a text, and so does a share of stretches that
are clearly in another language.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
NO_LETTERS = re.compile(rb"[\x00-\x60\x7b-\x7f]+")


def letters(text: str) -> bytes:
    """UTF-8 of a text in lower case, with a blank for each run of ASCII that is no letter."""
    return NO_LETTERS.sub(b" ", text.lower().encode())


@dataclasses.dataclass(frozen=True)
class Settings:
    """`sample_rows` documents of `least_bytes` to `most_bytes` per language, in the order of a
    hash of their text, fill a dictionary of at most `dictionary_bytes`; scoring reads whole
    texts in stretches of about `stretch_bytes`. A margin (share of the size saved against the
    next best language) below `narrow` rejects a document; one shorter than `short_bytes` saves
    little in any language and has to pass `narrow_short` only. So does a share of `mixed` or
    more of stretches that another language wins by a margin of `sure`."""

    sample_rows: int = 100
    least_bytes: int = 200
    most_bytes: int = 6_000
    dictionary_bytes: int = 96_000
    stretch_bytes: int = 512
    lead_bytes: int = 256
    narrow: float = 0.015
    narrow_short: float = 0.002
    short_bytes: int = 100
    sure: float = 0.02
    mixed: float = 0.34


def fit(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """Dictionary bytes by language from `text` and `lang`; rows with either null are left out.

    Reads a bounded number of rows per language (`sample_rows`); equal texts count once.
    """
    s = settings
    size = F.octet_length("text")
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    drawn = (rows.where(size.between(s.least_bytes, s.most_bytes))
             .withColumn("place", F.row_number().over(order)).where(F.col("place") <= s.sample_rows))
    parts: dict[str, list[bytes]] = {}
    for r in drawn.select("lang", "text", "place").orderBy("lang", "place").collect():
        own, text = parts.setdefault(r["lang"], []), letters(r["text"])
        if text not in own and sum(map(len, own)) + len(text) <= s.dictionary_bytes:
            own.append(text)
    # languages whose documents are all short or long still count
    rest = rows.where(~F.col("lang").isin(list(parts))).where(size > 0) if parts else rows.where(size > 0)
    rest = rest.withColumn("text", F.substring("text", 1, s.dictionary_bytes))
    for r in rest.withColumn("place", F.row_number().over(order)).where("place <= 5").orderBy("lang", "place").collect():
        parts.setdefault(r["lang"], []).append(letters(r["text"])[: s.dictionary_bytes])
    return {lang: b"\n".join(x) for lang, x in parts.items()}


class Judge:
    """Language, score and rejection of a text, by one compressor per language."""

    def __init__(self, dictionaries: dict[str, bytes], s: Settings):
        self.names, self.s = sorted(dictionaries), s
        # matches of three letters count: words of a language share little more
        params = zstandard.ZstdCompressionParameters.from_level(
            1, strategy=zstandard.STRATEGY_LAZY2, min_match=3, write_content_size=0)
        self.coders, self.leads = [], []
        for name in self.names:
            raw = dictionaries[name]
            made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(dict_data=made, compression_params=params))
            # a piece follows a stretch of the dictionary, which costs little and keeps even a
            # short piece from being stored as it is
            self.leads.append(raw[-s.lead_bytes :] + b" ")

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not self.names or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        raw, s = letters(text), self.s
        width = -(-len(raw) // -(-len(raw) // s.stretch_bytes))
        sizes = np.array([[len(c.compress(lead + raw[i : i + width])) for c, lead in zip(self.coders, self.leads)]
                          for i in range(0, len(raw), width)])
        total = sizes.sum(0)
        if len(total) == 1:
            return self.names[0], 1.0, False
        best, winner = int(total.min()), int(total.argmin())
        runner_up = int(np.partition(total, 1)[1])
        score = 1.0 / sum(2.0 ** (max(best - int(x), -60) / 4) for x in total)
        margin = (runner_up - best) / runner_up
        narrow = margin < (s.narrow if len(raw) >= s.short_bytes else s.narrow_short)
        first, second = np.partition(sizes, 1, axis=1)[:, :2].T
        others = (sizes.argmin(1) != winner) & ((second - first) >= s.sure * second)
        return self.names[winner], score, bool(narrow or others.mean() >= s.mixed)


def classify(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings()) -> DataFrame:
    """`doc_id`, `lang_pred`, `score` and `rejected`, one row per row of docs (`doc_id`, `text`).

    A null text, or one without a letter, is `und` with score 0 and rejected, as is every
    text when no language was learned. Ties go to the first language by name; `score` is
    0.5 for a tie of two and nears 1 as the margin grows. Other columns are left aside.
    """
    s = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(dictionaries, s)
        for batch in batches:
            pred, score, out = zip(*[judge(x) for x in batch.column("text").to_pylist()]) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_clear(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, all columns as they are, whose `text` is not rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(dictionaries, settings)
        for batch in batches:
            yield batch.filter(pa.array([not judge(x)[2] for x in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

