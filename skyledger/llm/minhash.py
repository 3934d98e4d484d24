"""Near-duplicate documents by SetSketch registers.

A sketch holds, for each of `registers` independent registers, the smallest of one
exponential value per shingle, rounded down on an exponential scale of base 1.001 and
cut off at both ends. Registers of a union are the register-wise largest ones
(`merge_sketches`), and two sets agree in a register with a chance equal to their
similarity. Documents that agree in all registers of a band become candidates; the
numbers of larger, smaller and equal registers give the likelihood of each similarity,
which rules out most candidates; the rest is confirmed on full shingle sets.

The work goes in two passes, so that a large group of copies never yields all its pairs:
every set is first confirmed against one other set of its buckets, and the groups found
are then compared only where a bucket holds more than one of them.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm import texts
from skyledger.llm.components import components
from skyledger.session import stage

BASE = 1.001
LARGEST = 24.0  # an exponential value above this has register 0


@dataclasses.dataclass(frozen=True)
class Settings:
    """Sets are linked when `percent` * union <= 100 * intersection.

    `rows` registers form a band. At the lowest linked similarity of 0.85 a pair misses
    all 26 bands of 6 with a chance of 5 in a million, at 0.9 of 3 in a thousand millions.
    `doubt` is the log-likelihood ratio from which on a candidate is ruled out without
    looking at its sets; 18 stands for six standard deviations. Large buckets are compared
    in blocks of `tile` sets or `tile_shingles` shingles.
    """

    size: int = 5
    percent: int = 85
    bands: int = 26
    rows: int = 6
    doubt: float = 18.0
    tile: int = 512
    tile_shingles: int = 250_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def sketch(hashes: np.ndarray, at: np.ndarray, registers: int) -> np.ndarray:
    """Registers (rows x `registers`, 16 bits) of the sets `hashes[at[i]:at[i + 1]]`.

    The values of an element are the points of a Poisson process, each dealt to a random
    register, so that the first point of every register is exponential. Points rise, and
    an element is done once it is past what any register of its set still needs.
    """
    n, sizes = len(at) - 1, np.diff(at)
    least = np.full(n * registers, np.inf)
    # all registers of a set are filled below this bound but for a few in a thousand sets
    bound = np.where(sizes > 0, (np.log(registers) + 6.0) / np.maximum(sizes, 1), 0.0)
    row = np.repeat(np.arange(n), sizes)
    value, step = np.zeros(len(row)), 0
    hashes = hashes.astype(np.uint64)
    todo = np.arange(len(row))
    while len(todo):
        width = int(np.clip(1 << 14, len(todo), len(todo) * 64) // len(todo))
        draw = texts.mix(
            hashes[todo][:, None]
            + np.arange(step + 1, step + 1 + width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        )
        step += width
        points = value[todo][:, None] + np.cumsum(-np.log(texts.uniform(draw)), axis=1) / registers
        near = points <= bound[row[todo]][:, None]
        at_register = ((draw * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
        slot = row[todo][:, None] * registers + at_register.astype(np.int64)
        np.minimum.at(least, slot[near], points[near])
        value[todo] = points[:, -1]
        going = todo[near[:, -1]]
        if not len(going):
            # a register that is still empty needs points beyond the bound
            open_rows = np.flatnonzero((sizes > 0) & np.isinf(least.reshape(n, registers)).any(axis=1))
            if len(open_rows):
                return _wider(hashes, at, registers, open_rows, least)
        todo = going
    return _registers(least.reshape(n, registers))


def _wider(hashes, at, registers, open_rows, least) -> np.ndarray:
    """Sketches of a few sets anew, one element and all its points up to the cut-off at a time."""
    least = least.reshape(-1, registers)
    for r in open_rows:
        best = np.full(registers, np.inf)
        own = hashes[at[r] : at[r + 1]]
        value, step = np.zeros(len(own)), 0
        while np.isinf(best).any() or value.min() < best.max():
            width = max(1, 4096 // len(own))
            draw = texts.mix(own[:, None] + np.arange(step + 1, step + 1 + width, dtype=np.uint64)
                             * np.uint64(0x9E3779B97F4A7C15))
            step += width
            points = value[:, None] + np.cumsum(-np.log(texts.uniform(draw)), axis=1) / registers
            slot = ((draw * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
            np.minimum.at(best, slot.astype(np.int64), points)
            value = points[:, -1]
        least[r] = best
    return _registers(least)


def _registers(least: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        level = np.floor(1.0 + np.log(LARGEST / least) / np.log(BASE))
    return np.clip(np.nan_to_num(level, neginf=0.0), 0, 65535).astype(np.uint16)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def log_likelihood(j, n_a, n_b, above, below, equal):
    """Of similarity `j`, given set sizes and how many registers of a are above, below and equal b's."""
    u = n_a / (n_a + n_b)
    v = 1.0 - u

    def higher(x):  # chance that a register is above the other's
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE)

    p, q = higher(u - v * j), higher(v - u * j)
    small = 1e-12
    return (above * np.log(np.maximum(p, small)) + below * np.log(np.maximum(q, small))
            + equal * np.log(np.maximum(1.0 - p - q, small)))


def ruled_out(n_a, n_b, above, below, equal, percent: int, doubt: float) -> np.ndarray:
    """Pairs whose similarity is below the threshold beyond doubt."""
    need = percent / 100.0
    impossible = 100 * np.minimum(n_a, n_b) < percent * np.maximum(n_a, n_b)
    grid = np.linspace(0.0, need, 41)[:-1, None]
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    best = log_likelihood(np.minimum(grid, top), n_a, n_b, above, below, equal).max(axis=0)
    at_need = log_likelihood(np.minimum(need, top), n_a, n_b, above, below, equal)
    return impossible | (best - at_need > doubt)


def _sketched(docs: DataFrame, s: Settings) -> DataFrame:
    """`doc_id`, `n_shingles`, a fingerprint of the set (`f1`, `f2`), and its registers."""
    schema = "doc_id long, n_shingles long, f1 long, f2 long, registers binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text"):
                hashes, at = texts.shingle_sets(part.column("text"), s.size)
                regs = sketch(hashes, at, s.registers)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array(np.diff(at)),
                    pa.array(texts.row_sums(hashes, at).view(np.int64)),
                    pa.array(texts.row_sums(texts.mix(hashes ^ np.uint64(0xA5A5A5A5)), at).view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ], ["doc_id", "n_shingles", "f1", "f2", "registers"])

    return docs.mapInArrow(run, schema)


def _band_rows(sets: DataFrame, s: Settings) -> DataFrame:
    """(`band` key, `band_no`, `id`): one row per set and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = texts.keys(s.rows, 3)
        salt = texts.keys(s.bands, 4)
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            regs = _matrix(batch.column("registers"), s)
            total = (regs.reshape(len(ids), s.bands, s.rows).astype(np.uint64) * factors).sum(axis=2, dtype=np.uint64)
            bands = texts.mix(total + salt[None, :])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bands.ravel().view(np.int64)), pa.array(np.tile(np.arange(s.bands, dtype=np.int32), len(ids))),
                 pa.array(np.repeat(ids, s.bands))], ["band", "band_no", "id"])

    return sets.select("id", "registers").mapInArrow(run, "band long, band_no int, id long")


def _matrix(column: pa.Array, s: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, s.registers)


def _counts(a: np.ndarray, b: np.ndarray):
    """Registers of a above, below and equal b's, along the last axis."""
    above, below = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    return above, below, a.shape[-1] - above - below


def _estimated(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs (`a`, `b`) that are not ruled out, with their number of equal registers."""
    side = lambda x: sets.select(
        F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("n_a", "n_b"))
            above, below, equal = _counts(_matrix(batch.column("r_a"), s), _matrix(batch.column("r_b"), s))
            left = ~ruled_out(n_a, n_b, above, below, equal, s.percent, s.doubt)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(left)), batch.column("b").filter(pa.array(left)),
                 pa.array(equal[left].astype(np.int64))], ["a", "b", "equal"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, equal long")


def _tile_links(rows: DataFrame, s: Settings) -> DataFrame:
    """Links between groups: a spanning forest of each tile's, confirmed on full sets.

    rows: `tile`, `side`, `id`, `component`, `n_shingles`, `registers`, `band_no`, `text`,
    sorted by tile, which bounds what a task holds at once. A pair counts only in the first
    band it shares. Candidates are taken by falling likeness, and those that earlier links
    of the tile have joined are left out, so no group yields all its pairs.
    """

    def candidates(group, n, regs, side, band):
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)
        for i in left:
            js = right[group[right] != group[i]]
            if side[i] == 1:  # both sides are the same block
                js = js[js > i]
            if not len(js):
                continue
            same = (regs[js] == regs[i]).reshape(len(js), s.bands, s.rows).all(axis=2)
            js = js[same.argmax(axis=1) == band]
            if not len(js):
                continue
            above, below, equal = _counts(regs[i], regs[js])
            left_over = ~ruled_out(n[i], n[js], above, below, equal, s.percent, s.doubt)
            yield np.full(left_over.sum(), i), js[left_over], equal[left_over]

    def links(ids, group, column, found):
        if not found:
            return
        i, j, equal = (np.concatenate(x) for x in zip(*found))
        used, place = np.unique(np.concatenate((i, j)), return_inverse=True)
        hashes, at = texts.shingle_sets(column.take(pa.array(used)), s.size)
        top: dict = {}

        def find(x):
            while (up := top.get(x, x)) != x:
                top[x] = top.get(up, up)
                x = up
            return x

        for k in np.argsort(-equal, kind="stable"):
            x, y = find(group[i[k]]), find(group[j[k]])
            if x == y:
                continue
            p, q = place[k], place[len(i) + k]
            p, q = hashes[at[p] : at[p + 1]], hashes[at[q] : at[q + 1]]
            if _linked(p, q, s.percent):
                top[y] = x
                yield ids[i[k]], ids[j[k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            batch = table.to_batches()[0]
            tile = batch.column("tile").to_numpy(zero_copy_only=False)
            edges = np.concatenate(([0], np.flatnonzero(tile[1:] != tile[:-1]) + 1))
            yield tiles(batch, edges[:-1], edges[1:])
            held = batch.slice(int(edges[-1]))
        if held is not None:
            yield tiles(held, [0], [held.num_rows])

    def tiles(batch, begins, ends):
        out = []
        for a, b in zip(begins, ends):
            own = batch.slice(int(a), int(b - a))
            ids, group, n, side, band = (own.column(x).to_numpy(zero_copy_only=False)
                                         for x in ("id", "component", "n_shingles", "side", "band_no"))
            regs = _matrix(own.column("registers"), s)
            out += links(ids, group, own.column("text"), list(candidates(group, n, regs, side, band[0])))
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are alike enough."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def confirmed(pairs: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """The pairs (`a`, `b`) of document ids that are linked by their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.slices(batch, "text_a"):
                (x, at_x), (y, at_y) = (texts.shingle_sets(part.column(c), s.size) for c in ("text_a", "text_b"))
                linked = np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    linked[i] = _linked(x[at_x[i] : at_x[i + 1]], y[at_y[i] : at_y[i + 1]], s.percent)
                keep = pa.array(linked)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    side = lambda x: docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    # rows of one `a` follow each other by hash only, and skewed keys are split by adaptive execution
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Components of near-duplicate documents.

    docs: `doc_id` long, `text`; other columns are left aside. Returns one row per row of
    docs: `doc_id`, `n_shingles`, `component_id` (the smallest doc_id reachable by links,
    itself included), `kept` (doc_id = component_id) and `copy_of` (the smallest doc_id
    with the same shingle set).

    A null, empty or blank text has an empty set and is linked with nothing. A null
    doc_id is linked with nothing, has no component and is kept. Repeated rows get equal
    results. An empty table gives an empty result.
    """
    s = settings
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(_sketched(docs, s), "sketches")
    sets = stage(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "f1", "f2")
        .agg(F.min("doc_id").alias("id"), F.first("registers").alias("registers")), "sets")
    bands = _band_rows(sets, s)
    buckets = bands.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("members")).where("members > 1").drop("members")
    shared = stage(bands.join(buckets, "band").select("band", "band_no", "id", "lead"), "buckets")

    # each set against the most alike of the sets that lead its buckets
    led = shared.where("id != lead").groupBy(F.col("id").alias("a"), F.col("lead").alias("b")).agg(F.count("*").alias("n"))
    best = (_estimated(led.select("a", "b"), sets, s)
            .groupBy("a").agg(F.max(F.struct("equal", (-F.col("b")).alias("b"))).alias("top"))
            .select("a", (-F.col("top.b")).alias("b")))
    links = stage(confirmed(best, docs, s), "links")
    found = components(links)

    # what is left: buckets that hold several groups
    grouped = (shared.join(found, "id", "left")
               .select("band", "band_no", "id", F.coalesce("component", "id").alias("component")))
    mixed = grouped.groupBy("band").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p != q")
    grouped = grouped.join(mixed.select("band"), "band")
    more = stage(_tile_links(_tiled(grouped, sets, docs, s), s), "links")
    if more.take(1):
        found = components(links.union(more))

    copies = sets.select("n_shingles", "f1", "f2", "id")
    out = (rows.select("doc_id", "n_shingles", "f1", "f2")
           .join(copies, ["n_shingles", "f1", "f2"], "left").join(found, "id", "left"))
    lonely = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(lonely, F.col("doc_id")).otherwise(F.coalesce("component", "id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.when(lonely, F.col("doc_id")).otherwise(F.col("id")).alias("copy_of"))


def _tiled(grouped: DataFrame, sets: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Members of each bucket dealt into blocks, and each pair of blocks as a tile of its own.

    A block has about `tile` sets, or fewer if they are large.
    """
    known = grouped.join(sets.select("id", "n_shingles", "registers"), "id")
    sizes = known.groupBy("band").agg(F.greatest(
        F.ceil(F.count("*") / s.tile), F.ceil(F.sum("n_shingles") / s.tile_shingles)).cast("int").alias("blocks"))
    dealt = known.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # side 1: a block against itself; 0 and 2: the lower and the higher block of a tile
    tiled = other.select(
        F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        F.when(F.col("block") == F.col("other"), 1).when(F.col("block") < F.col("other"), 0).otherwise(2).alias("side"),
        "id", "component", "n_shingles", "registers", "band_no")
    with_text = tiled.join(docs.select(F.col("doc_id").alias("id"), "text"), "id")
    return (with_text.repartition("tile").sortWithinPartitions("tile")
            .select("tile", "side", "id", "component", "n_shingles", "registers", "band_no", "text"))

def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, all columns as they are, that `near_duplicates` keeps.

    Of rows with one doc_id and equal text one stays; rows without doc_id all stay.
    """
    kept = near_duplicates(docs, settings).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("__kept_id")).distinct()
    ids = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__text", F.xxhash64("text"))
    named = ids.join(kept, F.col("__id") == F.col("__kept_id"), "left_semi").dropDuplicates(["__id", "__text"])
    return named.unionByName(ids.where("doc_id IS NULL")).select(*docs.columns)
