"""WARC archives with revisit records, and a globally ordered index of what they hold.

Writing: pages become WARC/1.1 records as text lines that end with the blank lines a record
ends with, so Spark's text writer puts archives wherever Spark can write. Reading: each
archive is parsed in a task and gives an index run sorted by URL key and capture time.
Runs are dealt to ranges of the key, and a loser tree merges the runs' slices of a range,
which keep the order their run has. Archives may be of one gzip member or of many.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skyledger.session import new_path, stage

RECORDS_PER_ARCHIVE = 2_000
ARCHIVE_BYTES = 64 << 20
ENTRIES_PER_RANGE = 50_000
RECORD_END = "\r\n\r\n"

# The base32 alphabet, and the profile of revisits by equal payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(hexed):
    """Upper-case base32 of a hexadecimal SHA-1, as a column expression (20 bits at a time)."""
    groups = [F.conv(F.substring(hexed, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    letters = [F.substring(F.lit(BASE32), F.shiftright(group, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1))
               for group in groups for i in range(4)]
    return F.concat(*letters)


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds `payload_bytes`, `sha1`, `refers_to` to pages (`page_id`, `url`, `html`, `captured`).

    Of equal payloads of at least `least_bytes` bytes the one with the smallest page_id is
    the response; `refers_to` names it in the others, and is null in responses. Rows that
    repeat that page_id are responses too, as is a row without page_id if no other has one.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("sha1", F.sha1(payload))
    groups = (pages.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1", "payload_bytes")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # written, so that Spark knows its size and broadcasts it only if that is small
    groups = stage(groups, "payload-groups")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(groups, ["sha1", "payload_bytes"], "left").withColumn("refers_to", refers).drop("first")


def write_archives(
    decided: DataFrame, path: str, records_per_archive: int = RECORDS_PER_ARCHIVE, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """One record per row, in gzip-compressed archives of at most so many records and bytes.

    Records of some size, within a factor of two, go to archives of their own, as many to
    each as fit; those below `archive_bytes / records_per_archive` share theirs. A record
    larger than that bound is an archive by itself.
    Control characters in a URL are percent-encoded; a null URL or id is written as `-`.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce("html", F.lit("")))
    url = F.regexp_replace(F.regexp_replace(text("url"), "\r", "%0D"), "\n", "%0A")
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), text("page_id"),
        F.lit(">\r\nWARC-Date: "), F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: <urn:page:"),
                                 text("refers_to"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"),
        F.lit("\r\n\r\n"), http, body)
    # no record is longer: what is not payload or URL takes some 600 bytes
    longest = F.col("payload_bytes") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + 1024
    least = max(10, (archive_bytes // records_per_archive).bit_length() - 1)
    size = F.greatest(F.ceil(F.log2(longest)).cast("int"), F.lit(least)).alias("size")
    # a row per power of two
    sizes = sorted(r["size"] for r in decided.select(size).distinct().collect())
    for power in sizes or [least]:
        (decided.where(size == power).select(record.alias("record")).write.mode("append").option("lineSep", RECORD_END)
         .option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, min(records_per_archive, archive_bytes >> power))).text(f"{path}/size={power}"))


class Unzipped:
    """Reads lines and blocks from a gzip-compressed archive, a part at a time.

    Any number of gzip members follow each other, as archives with one per record have
    them; zeros may pad their ends. What ends within a member is an error.
    """

    def __init__(self, raw: bytes, part: int = 1 << 18):
        self.raw, self.at, self.part, self.held = raw, 0, part, bytearray()
        self.zip, self.rest = None, b""

    def more(self) -> bool:
        """Unpacks up to four times a part; false at the end of the archive."""
        if not self.rest:
            self.rest = self.raw[self.at : self.at + self.part]
            self.at += len(self.rest)
        if self.zip is None:
            self.rest = self.rest.lstrip(b"\0")
            if not self.rest:
                return self.at < len(self.raw)
            self.zip = zlib.decompressobj(31)
        ended = not self.rest
        found = self.zip.decompress(self.rest, 4 * self.part)
        self.held += found
        self.rest = self.zip.unconsumed_tail
        if self.zip.eof:
            self.rest, self.zip = self.zip.unused_data, None
        elif ended and not found:
            raise ValueError("an archive ends within a gzip member")
        return True

    def block(self, size: int) -> bytes:
        while len(self.held) < size and self.more():
            pass
        if len(self.held) < size:
            raise ValueError("an archive ends within a record")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def head(self) -> str | None:
        """Up to the next empty line, or None at the end."""
        seen = 0
        while (end := self.held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record's head")
                return None
        out = self.block(end + 4)
        return out[:-4].decode()


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of each record of an archive."""
    source = Unzipped(raw)
    while (head := source.head()) is not None:
        version, *lines = head.split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        block = source.block(int(fields["content-length"]))
        if source.block(4) != RECORD_END.encode():
            raise ValueError("a record does not end with an empty line")
        yield fields, block


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, in lower case: all captures of a site are neighbours.

    The scheme, `www.`, user, fragment and default ports do not count; what is no URL is its own key.
    """
    try:
        parts = urlsplit(url.strip().lower())
        port = parts.port
    except ValueError:
        return url.lower()
    host = (parts.hostname or "").removeprefix("www.")
    if not host:
        return url.lower()
    suffix = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{suffix}){parts.path or '/'}{query}"


def _number(field: str | None) -> int | None:
    value = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.lstrip("-").isdigit() else None


ENTRY = ("url_key string, captured string, page_id long, run string, place long, record_type string, "
         "payload_bytes long, payload_digest string, refers_to long, position long")
NAMES = [c.split()[0] for c in ENTRY.split(", ")]
KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS)], NAMES)


def _order(entry) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below `path`, each archive's in order of URL key and time.

    `position` is an entry's place in this order of its run.

    A response's digest and size are taken from its payload and must agree with its head; a
    revisit's come from its head. An archive is unpacked a part at a time, and one archive
    is one binary value, so those of others must stay below 2 GB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column("path"), batch.column("content")):
                name, entries = name.as_py(), []
                for place, (fields, block) in enumerate(records(raw.as_py())):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest or size != len(payload):
                            raise ValueError(f"payload and head differ in record {place} of {name}")
                    entries.append((url_key(fields["warc-target-uri"]), fields["warc-date"], _number(fields["warc-record-id"]),
                                    name, place, fields["warc-type"], size, digest, _number(fields.get("warc-refers-to"))))
                entries.sort(key=_order)
                yield _entry_batch([(*entry, position) for position, entry in enumerate(entries)])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ENTRY)


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merges sorted lists with a loser tree: a match per level and entry.

    `tree[1:]` holds the loser of the match at each inner node; the overall winner moves on.
    An exhausted run loses every match.
    """
    k = max(1, len(runs))
    at = [0] * k
    end = (1,)
    heads = [(0, *_order(r[0])) if r else end for r in runs] or [end]

    def winner(node: int) -> int:
        if node >= k:
            return node - k
        a, b = winner(2 * node), winner(2 * node + 1)
        if heads[b] < heads[a]:
            a, b = b, a
        tree[node] = b
        return a

    tree = [0] * k
    best = winner(1) if k > 1 else 0
    while heads[best] is not end:
        yield runs[best][at[best]]
        at[best] += 1
        own = runs[best]
        heads[best] = (0, *_order(own[at[best]])) if at[best] < len(own) else end
        node = (best + k) // 2
        while node:
            if heads[tree[node]] < heads[best]:
                tree[node], best = best, tree[node]
            node //= 2


def merged_index(runs: DataFrame, entries_per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """All entries in global order of URL key, capture time and page id.

    `runs` is read more than once, so give a written table. Ranges are cut by the whole
    order, so that many captures of one URL spread over tasks; each holds about
    `entries_per_range` entries. A run's entries reach a range by their position in the run,
    and the loser tree does the rest. `index_range` and `index_place` number the entries in
    order, and `capture` counts the captures of a URL key from 0, over all ranges it spans.
    """
    keys = ["url_key", "captured", "page_id", "run", "place"]
    ranges = max(1, -(-runs.count() // entries_per_range))
    dealt = runs.repartitionByRange(ranges, *[F.asc_nulls_first(k) for k in keys]).withColumn(
        "index_range", F.spark_partition_id()).sortWithinPartitions("run", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        number = 0
        for batch in batches:
            if batch.num_rows:
                number = batch.column("index_range")[0].as_py()
            for entry in zip(*(batch.column(c).to_pylist() for c in NAMES)):
                slices.setdefault(entry[3], []).append(entry)
        out, captures, place, last, n = [], [], 0, None, 0
        for entry in merge_runs(list(slices.values())):
            n = n + 1 if entry[0] == last else 0
            last = entry[0]
            out.append(entry)
            captures.append(n)
            if len(out) == 10_000:
                yield numbered(out, captures, number, place)
                place, out, captures = place + len(out), [], []
        if out:
            yield numbered(out, captures, number, place)

    def numbered(out, captures, number, place):
        batch = _entry_batch(out)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([number] * len(out), pa.int32()),
             pa.array(range(place, place + len(out)), pa.int64()), pa.array(captures, pa.int64())],
            [*NAMES, "index_range", "index_place", "capture"])

    merged = stage(dealt.mapInArrow(run, f"{ENTRY}, index_range int, index_place long, capture long"), "index")
    return _whole_histories(merged)


def _whole_histories(merged: DataFrame) -> DataFrame:
    """Adds to `capture` what earlier ranges hold of the URL key a range begins with.

    Only a range's first key can have begun before it, and all ranges that hold an earlier
    part of that key end with it; so one small row per range tells.
    """
    ends = merged.groupBy("index_range").agg(
        F.min("url_key").alias("first"), F.max("url_key").alias("last"),
        (F.max(F.struct("url_key", "capture"))["capture"] + 1).alias("n"))
    earlier = Window.partitionBy("last").orderBy("index_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("before", F.sum("n").over(earlier))
    # a range within a key goes on from those before it; one that begins with another's last key has all of that
    whole = ends.groupBy(F.col("last").alias("key")).agg(F.sum("n").alias("total"))
    told = ends.join(whole, F.col("first") == F.col("key"), "left").select(
        F.col("index_range").alias("own_range"), "first",
        F.coalesce(F.when(F.col("first") == F.col("last"), F.col("before")).otherwise(F.col("total")), F.lit(0)).alias("ahead"))
    more = F.when(F.col("url_key") == F.col("first"), F.col("ahead")).otherwise(0)
    return merged.join(told, merged["index_range"] == told["own_range"]).withColumn(
        "capture", F.col("capture") + more).drop("own_range", "first", "ahead", "position")


def archive_and_index(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Writes pages (`page_id`, `url`, `html`, `captured` timestamp) as archives and returns their index.

    A null html is an empty payload. Every row is a record: repeated rows are repeated
    records. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "captured")
    write_archives(decide(pages, least_bytes), path)
    return merged_index(stage(read_runs(spark, path), "runs"))
