"""Customer clusters: scaling, choice of k, assignment, profiles, projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions.numeric import half_even
from patronage.operators.sweep import Fits, cluster_number, labelled_figures, sweep
from patronage.session import full_rounds, written

ID = "customer_id"


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (ID, "cluster")]


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation of each feature."""

    means: dict[str, float]
    deviations: dict[str, float]

    @classmethod
    def of(cls, features: DataFrame) -> Scaling:
        columns = feature_columns(features)
        row = features.agg(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).first()
        means = {c: float(row[f"m_{c}"] or 0.0) for c in columns}
        # A constant column is only centred.
        deviations = {c: float(row[f"s_{c}"] or 0.0) or 1.0 for c in columns}
        return cls(means, deviations)

    def apply(self, features: DataFrame) -> DataFrame:
        """The same columns, each with mean 0 and variance 1."""
        scaled = {
            c: ((F.col(c) - F.lit(self.means[c])) / F.lit(self.deviations[c])).alias(c) for c in self.means
        }
        return features.select([scaled.get(c, F.col(c)) for c in features.columns])


def scale(features: DataFrame) -> DataFrame:
    return Scaling.of(features).apply(features)


def points(scaled: DataFrame) -> tuple[DataFrame, int, int]:
    """``(customer_id, x)``, kept for many passes, with the numbers of rows and of tasks."""
    x = F.array(*[F.col(c).cast("double") for c in feature_columns(scaled)])
    n = scaled.count()
    parts = full_rounds(scaled.sparkSession, n)
    # As it comes, few files may hold most of the rows, and a pass waits for its longest task.
    rows = written(scaled.select(ID, x.alias("x")).repartition(parts, ID), "points")
    return rows.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK), n, parts


@dataclass(frozen=True)
class KChoice:
    """Outcome of the search for k with the figures it rests on."""

    k: int
    inertias: dict[int, float]
    silhouettes: dict[int, float]
    centres: np.ndarray | None = None
    passes: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(k, self.inertias[k], self.silhouettes[k], k == self.k) for k in sorted(self.inertias)]
        return spark.createDataFrame(rows, "k int, inertia double, silhouette double, chosen boolean")


def choose_k(inertias: dict[int, float], silhouettes: dict[int, float]) -> int:
    """The k of the best silhouette, unless the bend of the inertias is over two away from it.

    The bend is the largest second difference, named two above its position.
    """
    ks = sorted(inertias)
    by_silhouette = max(ks, key=lambda k: (silhouettes[k], -k))
    if len(ks) < 3:
        bend = ks[0]
    else:
        values = [inertias[k] for k in ks]
        second = [values[i + 2] - 2 * values[i + 1] + values[i] for i in range(len(values) - 2)]
        bend = second.index(max(second)) + 2
    return by_silhouette if abs(by_silhouette - bend) <= 2 else bend


def find_optimal_k(
    scaled: DataFrame, max_clusters: int = 10, seed: int = 42, starts: int = 10, max_iter: int = 300
) -> KChoice:
    """Fit every k from 2 on in one set of passes, measure inertia and silhouette, and choose."""
    rows, n, parts = points(scaled)
    try:
        ks = list(range(2, min(max_clusters, n - 1) + 1))
        if not ks:
            return KChoice(2, {}, {})
        found = sweep(rows, ID, ks, seed, starts, max_iter, parts=parts)
        _, silhouettes = labelled_figures(rows, Fits([found.centres[k] for k in ks]), ks, parts)
        by_k = dict(zip(ks, silhouettes))
        k = choose_k(found.inertias, by_k)
        return KChoice(k, found.inertias, by_k, found.centres[k], found.passes)
    finally:
        rows.unpersist()


def choice_for(scaled: DataFrame, labellings: dict[int, Column], columns: list[str] | None = None) -> KChoice:
    """The same figures and choice for labels that are given: for each k a label from 0 to k - 1.

    ``columns`` are the features, by default all but the id.
    """
    ks = sorted(labellings)
    x = F.array(*[F.col(c).cast("double") for c in columns or feature_columns(scaled)])
    rows = scaled.select(x.alias("x"), F.array(*[labellings[k].cast("int") for k in ks]).alias("labels"))
    inertias, silhouettes = (dict(zip(ks, f)) for f in labelled_figures(rows, "labels", ks))
    return KChoice(choose_k(inertias, silhouettes), inertias, silhouettes)


def fit_clusters(
    features: DataFrame,
    k: int | KChoice | None = None,
    max_clusters: int = 10,
    seed: int = 42,
    starts: int = 10,
    max_iter: int = 300,
) -> DataFrame:
    """Add ``cluster``; numbered by ascending centre, so labels do not depend on the start.

    ``k`` may be the outcome of :func:`find_optimal_k` on the same features, whose
    centres are then used; left out, that search is run.
    ``features`` is scanned several times; pass a written table.
    """
    scaling = Scaling.of(features)
    scaled = scaling.apply(features)
    if k is None:
        k = find_optimal_k(scaled, max_clusters, seed, starts, max_iter)
    centres = k.centres if isinstance(k, KChoice) else None
    if centres is None:
        wanted = k.k if isinstance(k, KChoice) else k
        rows, _, parts = points(scaled)
        try:
            centres = sweep(rows, ID, [wanted], seed, starts, max_iter, parts=parts).centres[wanted]
        finally:
            rows.unpersist()
    ordered = np.array(sorted(map(tuple, centres)))
    columns = feature_columns(features)
    scaled_values = [(F.col(c) - scaling.means[c]) / scaling.deviations[c] for c in columns]
    return features.select(*features.columns, cluster_number(scaled_values, ordered).alias("cluster"))


def fit_certificate(clustered: DataFrame) -> DataFrame:
    """One row on a fit: ``points``, ``clusters``, and ``off_nearest``, the points nearer to the mean of another cluster.

    It is 0 exactly if every centre is the mean of its points and every point is with its nearest centre.
    """
    scaled = scale(clustered)
    columns = feature_columns(scaled)
    means = scaled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns]).orderBy("cluster").collect()
    x = [F.col(c) for c in columns]
    squared = F.array(  # one per cluster
        *[sum(((v - r[c]) * (v - r[c]) for v, c in zip(x, columns)), F.lit(0.0)) for r in means]
    )
    own = F.element_at(squared, F.array_position(F.array(*[F.lit(r["cluster"]) for r in means]), F.col("cluster")).cast("int"))
    off = F.col("own") - F.col("least") > 1e-9 * (1 + F.col("own"))
    return (
        scaled.select(own.alias("own"), F.array_min(squared).alias("least"))
        .agg(F.count(F.lit(1)).alias("points"), F.count_if(off).alias("off_nearest"))
        .withColumn("clusters", F.lit(len(means)))
    )


def cluster_profiles(clustered: DataFrame) -> DataFrame:
    """Mean of every feature per cluster, with size and share."""
    total = clustered.agg(F.count(F.lit(1)).alias("n"))
    return (
        clustered.groupBy("cluster")
        .agg(
            *[half_even(F.avg(c), 2).alias(c) for c in feature_columns(clustered)],
            F.count(F.lit(1)).alias("size"),
        )
        .withColumn("pct_of_total", half_even(F.col("size") / total.scalar() * 100, 1))
    )


@dataclass(frozen=True)
class Components:
    """Principal components of the scaled features: loadings by column, and the variance along each."""

    columns: list[str]
    loadings: np.ndarray
    variances: np.ndarray
    total_variance: float


def _joined_moments(n: float, mean: np.ndarray, m: np.ndarray, other) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, means and centred co-moments of two sets of rows from those of each (Chan, Golub, LeVeque 1979)."""
    n2, mean2, m2 = other
    if not n2:
        return n, mean, m
    both, delta = n + n2, mean2 - mean
    return both, mean + delta * (n2 / both), m + m2 + np.outer(delta, delta) * (n * n2 / both)


def principal_components(scaled: DataFrame, k: int = 2) -> Components:
    """The ``k`` leading components from centred co-moments, which every task merges pairwise.

    A component is turned so that its largest loading is positive.
    """
    columns = feature_columns(scaled)
    d = len(columns)
    kind = "n double, mean array<double>, m array<double>"

    def merged(batches, rows_of) -> Iterator[pa.RecordBatch]:
        state = 0.0, np.zeros(d), np.zeros((d, d))
        for batch in batches:
            for other in rows_of(batch):
                state = _joined_moments(*state, other)
        n, mean, m = state
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([mean.tolist()]), pa.array([m.ravel().tolist()])], names=["n", "mean", "m"]
        )

    def of_points(batch: pa.RecordBatch):
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        if len(x):
            mean = x.mean(axis=0)
            yield float(len(x)), mean, (x - mean).T @ (x - mean)

    def of_states(batch: pa.RecordBatch):
        for n, mean, m in zip(*[c.to_pylist() for c in batch.columns]):
            yield n, np.array(mean), np.array(m).reshape(d, d)

    x = scaled.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    parts = x.mapInArrow(lambda batches: merged(batches, of_points), kind)
    # Tasks' moments are merged in 16 groups before the driver merges these.
    grouped = parts.repartition(16).mapInArrow(lambda batches: merged(batches, of_states), kind).collect()
    state = 0.0, np.zeros(d), np.zeros((d, d))
    for row in sorted(grouped, key=lambda r: (r["n"], r["mean"])):
        state = _joined_moments(*state, (row["n"], np.array(row["mean"]), np.array(row["m"]).reshape(d, d)))
    n, _, m = state
    covariance = m / max(n - 1.0, 1.0)
    values, basis = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:k]
    loadings = basis[:, order]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
    return Components(columns, loadings * np.where(signs == 0, 1.0, signs), values[order], float(np.trace(covariance)))


def pca_projection(clustered: DataFrame) -> DataFrame:
    """``(customer_id, cluster, pca_x, pca_y)``: the first two components of the scaled features."""
    scaled = scale(clustered)
    found = principal_components(scaled)
    spots = [
        sum((F.col(c) * float(w) for c, w in zip(found.columns, weights)), F.lit(0.0)) for weights in found.loadings.T
    ]
    return scaled.select(ID, "cluster", *[s.alias(name) for s, name in zip(spots, ("pca_x", "pca_y"))])
