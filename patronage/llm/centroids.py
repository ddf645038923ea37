"""Exact k-means over a VA-file: cells decide most assignments, full vectors are fetched for the rest.

Kept are vectors of exactly ``dims`` components, none null or non-finite; a
component x becomes the integer ``floor(scale * x)``. The VA-file holds one
byte per component: the number of its cell, of which both ends are known. What a
centroid c is farther away than another, p, is linear in every component, so
the ends of the cells bound it: two look-up tables (lower and upper end of each
cell) and the centroids give the interval. p is the centroid nearest to the
middles of the cells. Where every other centroid's interval lies above 0, the
vector belongs to p without a look at it; where intervals overlap, its full
vector is fetched and measured in integers. So results are those of a plain scan.

The cells' inner ends are quantiles of a sample of ``SAMPLE_ROWS`` vectors (the
smallest hashes), the outer ones the least and largest value of all; the sample
has an effect on speed only. Sums per cluster are kept from round to round:
only vectors that move, or may have, are fetched. Their side of the join is
written first, so that Spark broadcasts it if its size allows, else sorts.

Starts are the ``k`` vectors of the smallest SHA-256 of ``<salt>:<vec_id>``,
then of the smallest components; those without an id come last. With fewer than
``k`` vectors there are as many centroids. Of equally near centroids the one
with the smaller number wins. Rows that repeat are vectors of their own. No vector,
no rows. Components of ``LARGEST`` or more after scaling are an error, as their
distances need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import partitions_for, written

SAMPLE_ROWS = 4096
CELLS = 256
LARGEST = 1 << 27
BLOCK_ROWS = 8192

_STATE = "row_va long, cells_va binary, now_va int, sums_va array<long>, size_va long"


@dataclass(frozen=True)
class Cells:
    """Ends of every cell, ``(dims, CELLS)``; a cell that holds nothing has its lower end above its upper one."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, least: np.ndarray, largest: np.ndarray) -> Cells:
        """Cells between the quantiles of each component of ``sample``."""
        low = np.empty((sample.shape[1], CELLS), np.int64)
        high = np.empty_like(low)
        for i, column in enumerate(np.sort(sample, axis=0).T):
            edges = column[np.arange(1, CELLS) * len(column) // CELLS]
            low[i] = np.concatenate([least[i : i + 1], np.maximum(edges, least[i])])
            high[i] = np.concatenate([edges - 1, largest[i : i + 1]])
        return cls(low, high)

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of every component."""
        found = [np.searchsorted(self.low[i, 1:], vectors[:, i], side="right") for i in range(vectors.shape[1])]
        return np.stack(found, axis=1).astype(np.uint8)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _cells_of(column: pa.Array, dims: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def judged(cells: np.ndarray, table: Cells, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likely centroid of every row of cells, and whether the intervals leave no other one."""
    at = np.arange(cells.shape[1])
    low, high = table.low[at, cells], table.high[at, cells]
    exact = np.int64 if max(abs(table.low).max(), abs(table.high).max()) >= 1 << 20 else np.float64
    squares = (centroids**2).sum(axis=1)
    middle = (low + high) / 2.0
    pivot = (squares - 2.0 * (middle @ centroids.T)).argmin(axis=1)
    low, high = low.astype(exact), high.astype(exact)
    sure = np.ones(len(cells), bool)
    for p in np.unique(pivot):
        rows = np.flatnonzero(pivot == p)
        slope = (2 * (centroids[p] - centroids)).astype(exact)  # of: how much farther is c than p
        least = low[rows] @ np.maximum(slope, 0).T + high[rows] @ np.minimum(slope, 0).T + (squares - squares[p])
        # A tie goes to the smaller number.
        above = np.where(np.arange(len(centroids)) < p, least > 0, least >= 0)
        above[:, p] = True
        sure[rows] = above.all(axis=1)
    return pivot.astype(np.int32), sure


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    distances = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    return distances.argmin(axis=1).astype(np.int32)


def _sums(vectors: np.ndarray, sign: int, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.stack([vectors[cluster == c].sum(axis=0) for c in range(k)])
    return sign * total, sign * np.bincount(cluster, minlength=k)


def _state_batch(rows, cells: pa.Array, now: np.ndarray, total: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Rows of the state, and one row of sums for each cluster that has any."""
    touched = np.flatnonzero((total != 0).any(axis=1) | (size != 0))
    n, k = len(now), len(touched)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([rows, pa.nulls(k, pa.int64())]),
            pa.concat_arrays([cells.cast(pa.binary()), pa.nulls(k, pa.binary())]),
            pa.array(np.concatenate([now, touched]).astype(np.int32)),
            pa.array([None] * n + total[touched].tolist(), pa.list_(pa.int64())),
            pa.array([None] * n + size[touched].tolist(), pa.int64()),
        ],
        names=["row_va", "cells_va", "now_va", "sums_va", "size_va"],
    )


def first_assignment(coded: DataFrame, table: Cells, centroids: np.ndarray) -> DataFrame:
    """State and sums of the first round, which needs every vector for its sums."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            vectors = _matrix(batch.column(2), dims)
            now, sure = judged(_cells_of(batch.column(1), dims), table, centroids)
            if not sure.all():
                now[~sure] = nearest(vectors[~sure], centroids)
            yield _state_batch(batch.column(0), batch.column(1), now, *_sums(vectors, 1, now, k))

    return coded.select("row_va", "cells_va", "v_va").mapInArrow(run, _STATE)


def by_cells(state: DataFrame, table: Cells, centroids: np.ndarray) -> DataFrame:
    """``row_va, cells_va, was_va, now_va`` by the VA-file alone; ``now_va`` is null where intervals overlap."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            now, sure = judged(_cells_of(batch.column(1), dims), table, centroids)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(now, mask=~sure)], names=["row_va", "cells_va", "was_va", "now_va"]
            )

    rows = state.select("row_va", "cells_va", "now_va")
    return rows.mapInArrow(run, "row_va long, cells_va binary, was_va int, now_va int")


def fetched(open_: DataFrame, coded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """State of the rows whose vectors are fetched, and by how much they change the sums."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            vectors = _matrix(batch.column(3), dims)
            was = batch.column(2).to_numpy(zero_copy_only=False)
            now = nearest(vectors, centroids)
            moved = now != was
            gone = _sums(vectors[moved], -1, was[moved], k)
            come = _sums(vectors[moved], 1, now[moved], k)
            yield _state_batch(batch.column(0), batch.column(1), now, gone[0] + come[0], gone[1] + come[1])

    rows = open_.select("row_va", "cells_va", "was_va").join(coded.select("row_va", "v_va"), "row_va")
    return rows.select("row_va", "cells_va", "was_va", "v_va").mapInArrow(run, _STATE)


def _added(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, list[int]]:
    """Sums and sizes per cluster: ``k * dims`` rows come to the driver."""
    found = (
        state.where("row_va IS NULL")
        .select("now_va", "size_va", F.posexplode("sums_va"))
        .groupBy("now_va", "pos")
        .agg(F.sum("col").alias("sum"), F.sum("size_va").alias("size"))
    )
    sums, sizes = np.zeros((k, dims), object), [0] * k
    for row in found.collect():
        sums[row["now_va"], row["pos"]], sizes[row["now_va"]] = row["sum"], row["size"]
    return sums, sizes


def _coded(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int, salt: str, k: int):
    """The written vectors with their cells, the cells' ends and the starts; nothing if no vector is kept."""
    value = F.col(embedding)
    fine = F.forall(value, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    scaled = F.transform(value, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    rows = vectors.where((F.size(value) == dims) & fine).select(
        F.monotonically_increasing_id().alias("row_va"), F.col(vec_id).alias("id_va"), scaled.alias("v_va")
    )
    tame = F.forall("v_va", lambda x: F.abs(x) < LARGEST)
    checked = F.when(tame, F.col("v_va").cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"a component of {LARGEST} or more after scaling")).cast("array<int>")
    )
    base = written(rows.withColumn("v_va", checked), "va-vectors")
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id_va").cast("string")), 256)
    starts = base.select("v_va", name.alias("name")).orderBy(F.col("name").asc_nulls_last(), "v_va").limit(k).collect()
    if not starts:
        return None

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            v = _matrix(batch.column(0), dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims)), pa.array(v.min(axis=0)), pa.array(v.max(axis=0))], names=["i", "low", "high"]
            )

    span = (
        base.select("v_va").mapInArrow(ends, "i long, low long, high long")
        .groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    )
    sample = base.orderBy(F.xxhash64("row_va"), "row_va").limit(SAMPLE_ROWS).select("v_va").collect()
    table = Cells.of(
        np.array([r[0] for r in sample], np.int64),
        np.array([r["low"] for r in span], np.int64), np.array([r["high"] for r in span], np.int64),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            cells = table.numbers(_matrix(batch.column(2), dims))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in cells], pa.binary())],
                names=["row_va", "id_va", "v_va", "cells_va"],
            )

    kind = base.schema["id_va"].dataType.simpleString()
    coded = written(
        base.mapInArrow(encode, f"row_va long, id_va {kind}, v_va array<int>, cells_va binary"), "va-file"
    )
    return coded, table, np.array([r["v_va"] for r in starts], np.int64)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    salt: str = "3",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every kept vector, and the final centroids.

    Each round assigns every vector and then replaces every centroid that has any
    by the componentwise ``floor(sum / count)``; vectors are assigned once more
    afterwards. Writes and runs jobs when called.
    """
    made = _coded(vectors, vec_id, embedding, dims, scale, salt, k)
    kind = vectors.schema[vec_id].dataType.simpleString()
    if made is None:
        return vectors.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, cluster int, distance long"), []
    coded, table, centroids = made
    k = len(centroids)
    sums, sizes = np.zeros((k, dims), object), [0] * k
    state = None
    for _ in range(rounds):
        if state is None:
            state = changed = written(first_assignment(coded, table, centroids), "va-state")
        else:
            # The state is a union of what stays and what was fetched, whose parts would add up from round to round.
            parts = max(vectors.sparkSession.sparkContext.defaultParallelism, partitions_for(sum(sizes)))
            found = written(by_cells(state.where("row_va IS NOT NULL").coalesce(parts), table, centroids), "va-judged")
            open_ = written(found.where("now_va IS NULL OR now_va <> was_va"), "va-open")
            changed = written(fetched(open_, coded, centroids), "va-fetched")
            settled = found.where("now_va = was_va").select("row_va", "cells_va", "now_va")
            state = settled.unionByName(changed.where("row_va IS NOT NULL").select("row_va", "cells_va", "now_va"))
        more, more_sizes = _added(changed, k, dims)
        sums, sizes = sums + more, [a + b for a, b in zip(sizes, more_sizes)]
        centroids = np.array(
            [[int(s) // n for s in sums[c]] if n else centroids[c].tolist() for c, n in enumerate(sizes)], np.int64
        )

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            v = _matrix(batch.column(2), dims)
            now, sure = judged(_cells_of(batch.column(1), dims), table, centroids)
            if not sure.all():
                now[~sure] = nearest(v[~sure], centroids)
            distance = ((v - centroids[now]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(now), pa.array(distance)], names=[vec_id, "cluster", "distance"]
            )

    rows = coded.select("id_va", "cells_va", "v_va")
    result = rows.mapInArrow(last, f"`{vec_id}` {kind}, cluster int, distance long")
    return written(result, "va-result"), centroids.tolist()


def report(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", **options) -> DataFrame:
    """The clusters with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, the digest of the centroid's components."""
    found, centroids = cluster(vectors, vec_id, embedding, **options)
    spark = vectors.sparkSession
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    per = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per centroid
    rows = [(c, per.get(c, 0), sum(per.values()), digest) for c, digest in digests]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        vec_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
