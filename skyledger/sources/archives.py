"""Zip archives of CSV files, read by Spark and unpacked inside its tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.schemas import extended

# Bytes of a member unpacked at a time.
CHUNK = 4 << 20

# Lines handed back to Spark at a time, so an archive never sits unpacked in memory.
LINES_PER_BATCH = 20_000

# Lines a record may span; one whose quotes stay open longer is broken.
LINES_PER_RECORD = 64

# Column of what could not be read as a record.
CORRUPT = "corrupt_record"


def read_archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """Archives below `path` as rows (`path`, `content`), spread over tasks by size.

    The file name is matched without regard to case; `*` stands for any characters, `?` for
    one, and all others for themselves. Spark refuses files over its 2 GB binary limit
    instead of cutting them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    wanted = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern.lower())
    return files.where(name.rlike(f"^{wanted}$")).select("path", "content")


def _member_lines():
    """A reader of archives' CSV members that travels to the executors whole, without this package."""
    chunk = CHUNK

    def member_lines(
        batches: Iterator[pa.RecordBatch], ends: bool = False
    ) -> Iterator[tuple[str, str, pa.Array | None]]:
        """(path, member, lines with their line breaks), some at a time; `ends`: None once a member is over."""
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path = path.as_py()
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                    for member in [m for m in archive.namelist() if m.lower().endswith(".csv")]:
                        with archive.open(member) as raw:
                            begun: list[bytes] = []  # a line whose end has not come
                            while True:
                                piece = raw.read(chunk)
                                cut = piece.rfind(b"\n") + 1
                                if piece and not cut:
                                    begun.append(piece)
                                    continue
                                text = b"".join([*begun, piece[:cut]]).decode("utf-8", "replace")
                                begun = [piece[cut:]]
                                if text:
                                    parts = pc.split_pattern(pa.array([text], pa.large_string()), "\n").values.cast(pa.string())
                                    # All but the last have lost their break.
                                    broken = pc.binary_join_element_wise(parts.slice(0, len(parts) - 1), "\n", "")
                                    ending = parts.slice(len(parts) - 1)
                                    yield path, member, broken if text.endswith("\n") else pa.concat_arrays([broken, ending])
                                if not piece:
                                    break
                        if ends:
                            yield path, member, None

    return member_lines


def unpack_lines(archives: DataFrame, lines_per_batch: int = LINES_PER_BATCH) -> DataFrame:
    """The lines of every CSV member: (`path`, `member`, `line`).

    Decompression is the one step Spark has no operator for; it runs as Arrow
    batches, one archive at a time per task. Everything after it is column work. A task
    is handed archives up to `spark.sql.execution.arrow.maxBytesPerBatch` (64 MB unless
    set) together, and a larger one alone.
    """

    # Defined here so that it travels to the executors whole, without this package.
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, member, lines in member_lines(batches):
            lines = pc.ascii_rtrim(lines, "\r\n")
            for at in range(0, len(lines), lines_per_batch):
                some = lines.slice(at, lines_per_batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(path, len(some)), pa.repeat(member, len(some)), some], ["path", "member", "line"])

    member_lines = _member_lines()
    return archives.select("path", "content").mapInArrow(
        unpack, "path string, member string, line string"
    )


def unpack_records(
    archives: DataFrame, records_per_batch: int = LINES_PER_BATCH, lines_per_record: int = LINES_PER_RECORD
) -> DataFrame:
    """The CSV records of every member: (`path`, `member`, `record`, `closed`).

    A line break inside a quoted field belongs to the field. A field is quoted if it begins with
    a quote, and ends at a quote that is not doubled, which only blanks may follow before the next
    comma or the end. A record whose field is still open after
    `lines_per_record` lines, or at the end of the member, is broken: its first line comes by itself,
    not `closed`, and the next line begins a record, so an open quote costs its own
    line only and no line is lost. Blank lines are no records.
    """

    # Defined here so that they travel to the executors whole, without this package.
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Without possessive parts these read the same: how a field goes on is told by its next character.
        field = r'(?:"(?:[^"]|"")*"[ \t]*|[^",][^,]*|)'
        whole = rf"\A{field}(?:,{field})*\z"
        # What Python calls white space.
        blank = r"\A[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*\z"
        field = r'(?:"(?:[^"]++|"")*+"[ \t]*+|[^",][^,]*+|)'
        opened = re.compile(rf'(?:{field},)*+"(?:[^"]++|"")*+')
        ended = re.compile(rf'(?:[^"]++|"")*+"[ \t]*+(?:,{field})*+')
        again = re.compile(rf'(?:[^"]++|"")*+"[ \t]*+,(?:{field},)*+"(?:[^"]++|"")*+')

        def record(lines: pa.Array, at: int) -> int | None:
            """The line after a record that begins with an open field: `at` if it is broken, None if `lines` end first."""
            if opened.fullmatch(lines[at].as_py().rstrip("\r\n")) is None:
                return at
            for number in range(at + 1, at + lines_per_record):
                if number >= len(lines):
                    return None
                more = lines[number].as_py().rstrip("\r\n")
                if '"' not in more:
                    continue
                if ended.fullmatch(more) is not None:
                    return number + 1
                # Neither closed nor open: no further line can close it.
                if again.fullmatch(more) is None and more.replace('""', "").count('"'):
                    return at
            return at

        def rows(path: str, member: str, found: pa.Array, closed: pa.Array) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(found), records_per_batch):
                some, state = found.slice(start, records_per_batch), closed.slice(start, records_per_batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(path, len(some)), pa.repeat(member, len(some)), some, state],
                    ["path", "member", "record", "closed"])

        rest = pa.array([], pa.string())  # lines of a record that later ones go on; none once a member is over
        for path, member, lines in member_lines(batches, ends=True):
            last = lines is None
            lines = rest if last else pa.concat_arrays([rest, lines])
            trimmed = pc.ascii_rtrim(lines, "\r\n")
            single = pc.match_substring_regex(trimmed, whole).to_numpy(zero_copy_only=False)
            plain = single & ~pc.match_substring_regex(trimmed, blank).to_numpy(zero_copy_only=False)
            made, closed, free, end = [], [], 0, len(lines)
            for at in np.flatnonzero(~single).tolist():
                if at < free:
                    continue
                after = record(lines, at)
                if after is None and not last:
                    end = at
                    break
                if after is None or after == at:
                    made.append(trimmed[at].as_py())
                    closed.append(False)
                    free = at + 1
                else:
                    made.append("".join(lines.slice(at, after - at).to_pylist()).rstrip("\r\n"))
                    closed.append(True)
                    plain[at:after] = False
                    free = after
            plain[end:] = False
            good = trimmed.filter(pa.array(plain))
            yield from rows(path, member, good, pa.repeat(True, len(good)))
            yield from rows(path, member, pa.array(made, pa.string()), pa.array(closed, pa.bool_()))
            rest = lines.slice(end)

    member_lines = _member_lines()
    return archives.select("path", "content").mapInArrow(
        unpack, "path string, member string, record string, closed boolean"
    )


def parse_csv_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records to the declared columns and `corrupt_record`, in the JVM.

    What is not closed, has another number of fields, or holds a field that is not of its column's
    type keeps its text in `corrupt_record`, which is null in all good rows.
    """
    wanted = extended(schema, CORRUPT, T.StringType())
    row = F.from_csv(
        F.when(F.col("closed"), F.col("record")), wanted.simpleString()[len("struct<"):-1].replace(":", " "),
        {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    bad = F.when(~F.col("closed"), F.col("record")).otherwise(F.col(f"row.{CORRUPT}"))
    return records.withColumn("row", row).select(*[f"row.{f.name}" for f in schema], bad.alias(CORRUPT))


def land_records(spark: SparkSession, path: str, out: str, schema: T.StructType) -> DataFrame:
    """`land_archives` for exports whose fields may hold line breaks; broken records land too."""
    rows = parse_csv_records(unpack_records(read_archives(spark, path)), schema)
    rows.write.mode("overwrite").parquet(out)
    return spark.read.schema(extended(schema, CORRUPT, T.StringType())).parquet(out)


def parse_csv_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Quoted CSV lines to the declared columns, in the JVM."""
    row = F.from_csv(
        F.col("line"), schema.simpleString()[len("struct<"):-1].replace(":", " "),
        {"quote": '"', "escape": '"'},
    )
    return lines.select(row.alias("row")).select("row.*")


def land_archives(spark: SparkSession, path: str, out: str, schema: T.StructType) -> DataFrame:
    """Unpack once into Parquet at `out`, so later jobs scan columns in parallel."""
    rows = parse_csv_lines(unpack_lines(read_archives(spark, path)), schema)
    rows.write.mode("overwrite").parquet(out)
    return spark.read.schema(schema).parquet(out)
