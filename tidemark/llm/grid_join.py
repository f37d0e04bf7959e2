"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary, connected_components, store
from tidemark.session import ship_package

COSINE = 0.95
GRID_DIMENSIONS = 6
BOX_DIMENSIONS = 16
INTERVAL = 4096
BLOCK = 512


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, raw, size``: non-null ids with finite, non-zero vectors, as doubles."""
    raw = F.col("embedding").cast("array<double>")
    bad = F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(raw, lambda x: x == 0)
    return vectors.where(F.col("vec_id").isNotNull() & raw.isNotNull() & (F.size(raw) > 0) & ~bad & ~zero).select(
        F.col("vec_id").cast("long").alias("vec_id"), raw.alias("raw"), F.size(raw).alias("size"))


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as unit vectors in double precision."""
    rows = len(column)
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_directions(vectors: DataFrame, size: int, count: int) -> np.ndarray:
    """Leading eigenvectors of the covariance of unit vectors; sums are added up by Spark, one small matrix is collected."""
    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                x = np.hstack([x, np.ones((len(x), 1))])
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    rows = vectors.select("raw").mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((size + 1) ** 2)
    for r in rows:
        total[r["at"]] = r["value"]
    total = total.reshape(size + 1, size + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    _, directions = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(directions[:, ::-1][:, :count])


def _ordered(vectors: DataFrame, directions: np.ndarray, epsilon: float, grid: int, interval: int, total: int) -> DataFrame:
    """Vectors in epsilon grid order, cut into intervals: ``part, low, high, n, ids, data`` with a box of principal coordinates.

    The order is that of the grid cells of the leading directions, one after the other; equal cells go by a hash
    of the id, so that a crowded cell is spread over intervals as well.
    """
    axes = min(grid, directions.shape[1])

    def cells(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                where = np.floor(x @ directions[:, :axes] / epsilon).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(where[:, k]) for k in range(axes)], pa.array([u.tobytes() for u in x.astype("<f8")], pa.binary())],
                    names=["vec_id", *[f"c{k}" for k in range(axes)], "unit"])

    names = [f"c{k}" for k in range(axes)]
    placed = vectors.select("vec_id", "raw").mapInArrow(
        cells, "vec_id long, " + ", ".join(f"{c} long" for c in names) + ", unit binary")
    order = [*names, F.xxhash64("vec_id")]
    parts = max(1, math.ceil(total / interval))
    sequence = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "unit").coalesce(parts)
    dims = directions.shape[0]

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, made, ids, units = TaskContext.get().partitionId(), 0, [], []

        def row():
            nonlocal made, ids, units
            take, ids = ids[:interval], ids[interval:]
            held, units = units[:interval], units[interval:]
            x = np.frombuffer(b"".join(held), "<f8").reshape(-1, dims)
            y = x @ directions
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 20) + made - 1]), pa.array([y.min(axis=0).tolist()]), pa.array([y.max(axis=0).tolist()]),
                 pa.array([len(take)]), pa.array([np.array(take, "<i8").tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                names=["part", "low", "high", "n", "ids", "data"])

        for batch in batches:
            ids += batch.column(0).to_pylist()
            units += binary(batch.column(1))
            while len(ids) >= interval:
                yield row()
        if ids:
            yield row()

    return sequence.mapInArrow(cut, "part long, low array<double>, high array<double>, n long, ids binary, data binary")


def _gap(low, high, other_low, other_high) -> float:
    """Least squared distance of two boxes."""
    d = np.maximum(0, np.maximum(low - other_high, other_low - high))
    return float((d * d).sum())


def _near_intervals(intervals: DataFrame, reach: float) -> DataFrame:
    """Pairs ``(x, y)``, x <= y, of intervals whose boxes are within reach.

    Every interval descends a binary tree over the sequence, whose nodes hold the boxes of runs of intervals, and
    leaves out whole runs that are provably distant. The tree has one box per ``INTERVAL`` vectors.
    """
    rows = sorted(intervals.select("part", "low", "high").collect(), key=lambda r: r["part"])
    keys = [r["part"] for r in rows]
    level = [(np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows]))]
    while len(level[-1][0]) > 1:
        low, high = level[-1]
        starts = np.arange(0, len(low), 2)
        level.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
    at = {k: i for i, k in enumerate(keys)}

    def descend(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            left, right = [], []
            for key in batch.column(0).to_pylist():
                me = at[key]
                low, high = level[0][0][me], level[0][1][me]
                stack = [(len(level) - 1, 0)]
                while stack:
                    depth, i = stack.pop()
                    if ((i + 1) << depth) <= me or _gap(low, high, level[depth][0][i], level[depth][1][i]) > reach:
                        continue
                    if depth:
                        stack += [(depth - 1, j) for j in (2 * i, 2 * i + 1) if j < len(level[depth - 1][0])]
                    else:
                        left.append(key)
                        right.append(keys[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["x", "y"])

    return intervals.select("part").mapInArrow(descend, "x long, y long")


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label, new)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare(x: np.ndarray, y: np.ndarray, same: bool, directions: np.ndarray, cosine: float, reach: float, block: int):
    """Links of two intervals: how many each vector has, and stars that span their components.

    The intervals are halved in turn and provably distant halves are left out. Blocks are compared in single
    precision with a margin far above its error, what is left in double precision.
    """
    counts = np.zeros(len(x) + (0 if same else len(y)), dtype=np.int64)
    shift = 0 if same else len(x)
    fine = x.astype(np.float32), y.astype(np.float32)
    along = x @ directions, y @ directions
    stars_a, stars_b = [], []
    stack = [(0, len(x), 0, len(y))]
    while stack:
        i, j, k, m = stack.pop()
        if same and m <= i:
            continue
        p, q = along[0][i:j], along[1][k:m]
        if _gap(p.min(axis=0), p.max(axis=0), q.min(axis=0), q.max(axis=0)) > reach:
            continue
        if j - i > block or m - k > block:
            if j - i >= m - k:
                half = i + block * max(1, (j - i) // block // 2)
                stack += [(i, half, k, m), (half, j, k, m)]
            else:
                half = k + block * max(1, (m - k) // block // 2)
                stack += [(i, j, k, half), (i, j, half, m)]
            continue
        a, b = np.nonzero(fine[0][i:j] @ fine[1][k:m].T >= cosine - 1e-4)
        a, b = a + i, b + k
        if same:
            a, b = a[b > a], b[b > a]
        sure = np.empty(len(a), bool)
        for lo in range(0, len(a), 65_536):
            s = slice(lo, lo + 65_536)
            sure[s] = np.einsum("nd,nd->n", x[a[s]], y[b[s]]) >= cosine
        a, b = a[sure], b[sure]
        if len(a):
            b = b + shift
            counts += np.bincount(a, minlength=len(counts)) + np.bincount(b, minlength=len(counts))
            nodes, local = np.unique(np.concatenate([a, b]), return_inverse=True)
            root = _components(len(nodes), local[:len(a)], local[len(a):])
            stars_a.append(nodes)
            stars_b.append(nodes[root])
    linked = np.flatnonzero(counts)
    if not len(linked):
        return linked, linked, linked
    root = _components(len(counts), np.concatenate(stars_a), np.concatenate(stars_b))
    return linked, counts[linked], root[linked]


def similar_vectors(vectors: DataFrame, cosine: float = COSINE, grid: int = GRID_DIMENSIONS, box: int = BOX_DIMENSIONS,
                    interval: int = INTERVAL, block: int = BLOCK) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``vec_id, n_links, component_id, kept`` for every row.

    Two vectors are linked if their cosine, in double precision, is at least ``cosine``; ``n_links`` counts the
    linked rows, ``component_id`` is the smallest id reachable. Vectors that are null, empty, zero or hold nulls,
    NaN or infinities link with nothing, nor do vectors of different lengths. A null id links with nothing, has a
    null component and is kept; rows that repeat an id are compared as rows and reported by id.

    Unit vectors are sorted in epsilon grid order along their leading principal directions, epsilon being the
    distance at the threshold; the sequence is cut into intervals of ``interval`` vectors, and pairs of intervals
    are joined recursively, leaving out what is provably distant along ``box`` directions. A task holds two
    intervals at a time. Of the links only counts and spanning stars leave a task, so a group of m near copies
    yields rows in proportion to m per pair of intervals, not m * m. Where the leading directions carry little of
    the variance nothing is provably distant and all intervals meet.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    good = usable(vectors)
    links = None
    for size, total in sorted((r["size"], r["n"]) for r in good.groupBy("size").agg(F.count("*").alias("n")).collect()):
        part = good.where(F.col("size") == size)
        directions = principal_directions(part, size, min(box, size))
        intervals, _ = store(_ordered(part, directions, epsilon, grid, interval, total), "intervals")
        near = _near_intervals(intervals, epsilon * epsilon)
        found, _ = store(_joined(near, intervals, directions, cosine, epsilon * epsilon, block), "vector-links")
        links = found if links is None else links.union(found)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = links.groupBy("vec_id").agg(F.sum("n").alias("n"))
    labels = connected_components(links.select(F.col("vec_id").alias("a"), F.col("anchor").alias("b")))
    named = counts.join(labels, F.col("vec_id") == F.col("node"), "left").select(F.col("vec_id").alias("k"), "n", "component")
    component = F.coalesce("component", "vec_id")
    return rows.join(named, F.col("vec_id") == F.col("k"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _joined(near: DataFrame, intervals: DataFrame, directions: np.ndarray, cosine: float, reach: float, block: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        dims = directions.shape[0]
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            data = [binary(batch.column(c)) for c in (2, 3, 4, 5)]
            for r, (i, j) in enumerate(keys):
                x, y = (np.frombuffer(data[c][r], "<f8").reshape(-1, dims) for c in (1, 3))
                ids = np.frombuffer(data[0][r], "<i8")
                if i != j:
                    ids = np.concatenate([ids, np.frombuffer(data[2][r], "<i8")])
                linked, n, root = _compare(x, y, i == j, directions, cosine, reach, block)
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(n), pa.array(ids[root])], names=["vec_id", "n", "anchor"])

    left, right = (intervals.select(F.col("part").alias(p), F.col("ids").alias(f"{p}_ids"), F.col("data").alias(f"{p}_data")) for p in "xy")
    pairs = near.join(left.hint("shuffle_hash"), "x").join(right.hint("shuffle_hash"), "y").select("x", "y", "x_ids", "x_data", "y_ids", "y_data")
    return pairs.mapInArrow(run, "vec_id long, n long, anchor long")
