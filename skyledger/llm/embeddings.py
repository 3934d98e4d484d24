"""Near-duplicate vectors of a label by PCA-ordered, tiled comparison.

Vectors are turned into the axes of their principal components and compared block against
block. A tile adds up products over the leading axes first; the norms of what remains bound
the rest, and a tile ends as soon as no pair of it can reach the threshold. Survivors are
computed anew from the vectors as given, in double precision.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.components import components
from skyledger.session import stage


@dataclasses.dataclass(frozen=True)
class Settings:
    """`block` vectors make a block; `box` leading axes bound it; `step` axes are added at a time."""

    cosine: float = 0.98
    block: int = 512
    box: int = 4
    step: int = 16


def _vectors(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `label`, `v` (null if it links with nothing), and a fingerprint of `v`."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = fine & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.when(fine, F.transform(v, lambda x: x + F.lit(0.0))).alias("v"))  # -0.0 becomes 0.0
    return rows.withColumn("f1", F.xxhash64("v", F.lit(1))).withColumn("f2", F.xxhash64("v", F.lit(2)))


def principal_axes(sets: DataFrame) -> dict[int, np.ndarray]:
    """Axes (columns, leading first) by dimension, from second moments of all unit vectors.

    Tasks send one matrix of dimension squared each time; a table holds few dimensions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_dimension(batch.column("v")):
                x = _unit(x)
                sums[d] = sums.get(d, 0) + x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([list(map(float, m.ravel())) for m in sums.values()], pa.list_(pa.float64()))], ["d", "m"])

    parts = sets.select("v").mapInArrow(run, "d int, m array<double>")
    cells = parts.select("d", F.posexplode("m").alias("cell", "x")).groupBy("d", "cell").agg(F.sum("x").alias("x"))
    total: dict[int, np.ndarray] = {}
    for r in cells.collect():
        total.setdefault(r["d"], np.zeros(r["d"] ** 2))[r["cell"]] = r["x"]
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1].copy() for d, m in total.items()}


def _by_dimension(column: pa.Array):
    """(dimension, rows, matrix) for each length of vectors in a batch."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, flat[at[rows][:, None] + np.arange(d)]


def _unit(x: np.ndarray) -> np.ndarray:
    # large and tiny numbers: scale first, so that squares stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _blocks(sets: DataFrame, axes: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """Blocks of vectors that are neighbours along the first axis: one row each, packed."""
    schema = ("label string, d int, first long, n int, low array<double>, high array<double>, "
              "ids binary, copies binary, v binary")

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, dims = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int32)
            for d, rows, x in _by_dimension(batch.column("v")):
                place[rows], dims[rows] = _unit(x) @ axes[d][:, 0], d
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "copies", "v")), pa.array(dims), pa.array(place)],
                ["id", "label", "copies", "v", "d", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            batch = table.to_batches()[0]
            key = list(zip(batch.column("label").to_pylist(), batch.column("d").to_pylist()))
            begin = 0
            for i in range(1, len(key)):
                if key[i] != key[begin] or i - begin == s.block:
                    yield packed(batch.slice(begin, i - begin))
                    begin = i
            held = batch.slice(begin)
        if held is not None and held.num_rows:
            yield packed(held)

    def packed(rows: pa.RecordBatch) -> pa.RecordBatch:
        (d, _, x), = _by_dimension(rows.column("v"))
        y = _unit(x) @ axes[d][:, : s.box]
        ids = rows.column("id").to_numpy(zero_copy_only=False)
        copies = rows.column("copies").to_numpy(zero_copy_only=False)
        # kept as 32-bit numbers where that loses nothing
        small = x.astype("<f4")
        raw = small.tobytes() if (small == x).all() else x.astype("<f8").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([rows.column("label")[0].as_py()]), pa.array([d], pa.int32()), pa.array([int(ids[0])], pa.int64()),
             pa.array([len(ids)], pa.int32()), pa.array([list(y.min(axis=0))], pa.list_(pa.float64())),
             pa.array([list(y.max(axis=0))], pa.list_(pa.float64())),
             pa.array([ids.astype("<i8").tobytes()]), pa.array([copies.astype("<i8").tobytes()]), pa.array([raw], pa.binary())],
            ["label", "d", "first", "n", "low", "high", "ids", "copies", "v"])

    placed = sets.select("id", "label", "copies", "v").mapInArrow(
        along, "id long, label string, copies long, v array<double>, d int, place double")
    ranged = placed.repartitionByRange("label", "d", "place", "id").sortWithinPartitions("label", "d", "place", "id")
    return ranged.mapInArrow(cut, schema)


def links_of_tile(a: np.ndarray, b: np.ndarray, axes: np.ndarray, s: Settings, same: bool):
    """Pairs (row of a, row of b) of cosine `s.cosine` or more; within one block only a < b."""
    u, v = _unit(a), _unit(b)
    p, q = u @ axes, v @ axes
    partial = np.zeros((len(p), len(q)))
    d = p.shape[1]
    for at in range(0, d, s.step):
        partial += p[:, at : at + s.step] @ q[:, at : at + s.step].T
        rest_p, rest_q = (np.sqrt((x[:, at + s.step :] ** 2).sum(axis=1)) for x in (p, q))
        # no rounding may lose a pair
        alive = partial + np.outer(rest_p, rest_q) >= s.cosine - 1e-9
        if same:
            alive &= np.tri(len(p), len(q), -1, dtype=bool).T
        if not alive.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if alive.mean() < 0.05:
            break
    i, j = np.nonzero(alive)
    keep = []
    for at in range(0, len(i), 1 << 15):
        x, y = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        keep.append((u[x] * v[y]).sum(axis=1) >= s.cosine)
    keep = np.concatenate(keep)
    return i[keep], j[keep]


def forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Numbers of the links that join something new: at most one fewer than vectors."""
    top: dict = {}

    def find(x):
        while (up := top.get(x, x)) != x:
            top[x] = top.get(up, up)
            x = up
        return x

    out = []
    for n, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = find(x), find(y)
        if x != y:
            top[y] = x
            out.append(n)
    return out


def _compared(pairs: DataFrame, axes: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """Per tile: (`a`, null, links) for linked vectors, and (`a`, `b`, 0) for links of a spanning forest."""

    def matrix(raw: bytes, n: int, d: int) -> np.ndarray:
        return np.frombuffer(raw, "<f4" if len(raw) == 4 * n * d else "<f8").astype(float).reshape(n, d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                ids_a, ids_b, own_a, own_b = (np.frombuffer(r[c], "<i8") for c in ("ids_a", "ids_b", "copies_a", "copies_b"))
                same = r["first_a"] == r["first_b"]
                i, j = links_of_tile(matrix(r["v_a"], len(ids_a), r["d"]), matrix(r["v_b"], len(ids_b), r["d"]),
                                     axes[r["d"]], s, same)
                n_a = np.bincount(i, own_b[j], minlength=len(ids_a)).astype(np.int64)
                n_b = np.bincount(j, own_a[i], minlength=len(ids_b)).astype(np.int64)
                tree = forest(ids_a[i], ids_b[j])
                ids = np.concatenate((ids_a[n_a > 0], ids_b[n_b > 0], ids_a[i[tree]]))
                other = [None] * int((n_a > 0).sum() + (n_b > 0).sum()) + ids_b[j[tree]].tolist()
                links = np.concatenate((n_a[n_a > 0], n_b[n_b > 0], np.zeros(len(tree), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(other, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])

    return pairs.mapInArrow(run, "a long, b long, links long")


def near_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links between vectors (`vec_id`, `embedding`, `label`) of one label and dimension.

    Per row: `vec_id`, `n_links` (other rows linked directly), `component_id` (smallest
    vec_id reachable, itself included) and `kept` (vec_id = component_id). A vector that is
    null, empty, all zero or holds a null, NaN or infinite component, or whose label is null,
    links with nothing; so does a null vec_id, which has no component and is kept. Rows
    with equal vectors and label link with each other and share all links. Other columns
    are left aside; an empty table gives an empty result.

    Equal vectors are compared once. A tile gives counts and a spanning forest, not pairs,
    so a large group of near copies does not yield all its pairs.
    """
    s = settings
    rows = stage(_vectors(vectors), "vectors")
    sets = stage(rows.where("v IS NOT NULL").groupBy("label", "f1", "f2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")), "distinct-vectors")
    axes = principal_axes(sets)
    blocks = stage(_blocks(sets, axes, s), "blocks")
    side = lambda x: blocks.select(
        "label", "d", *[F.col(c).alias(f"{c}_{x}") for c in ("first", "low", "high")])
    # boxes farther apart than vectors of that cosine can be never meet
    apart = F.aggregate(
        F.zip_with(F.arrays_zip("low_a", "high_a"), F.arrays_zip("low_b", "high_b"), lambda p, q: F.greatest(
            p["low_a"] - q["high_b"], q["low_b"] - p["high_a"], F.lit(0.0))),
        F.lit(0.0), lambda t, x: t + x * x)
    near = side("a").join(side("b"), ["label", "d"]).where("first_a <= first_b").where(apart <= 2 - 2 * s.cosine + 1e-9)
    packed = lambda x: blocks.select(
        F.col("first").alias(f"first_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("ids", "copies", "v")])
    pairs = (near.select("d", "first_a", "first_b").join(packed("a"), "first_a").join(packed("b"), "first_b"))
    found = stage(_compared(pairs, axes, s), "vector-links")
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    top = components(found.where("b IS NOT NULL").select("a", "b"))
    known = sets.select("label", "f1", "f2", "id", "copies").join(links, "id", "left").join(top, "id", "left")
    keyed = rows.select("vec_id", "label", "f1", "f2", F.col("v").isNotNull().alias("fine"))
    out = keyed.join(known, ["label", "f1", "f2"], "left")
    fine = F.col("fine") & F.col("id").isNotNull()
    component = F.when(fine, F.coalesce("component", "id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.when(fine, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
