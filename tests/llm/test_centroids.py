"""Clustering over the VA-file next to plain rounds over all vectors."""

import hashlib
import random

import numpy as np
import pytest

from patronage.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds, dims, scale=1024, salt="3"):
    """``vec_id, cluster, distance`` of the kept rows, and the centroids, by plain integers."""
    kept = []
    for vec_id, v, *_ in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            kept.append((vec_id, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    name = lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    means = [v for _, v in sorted(kept, key=name)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        groups = [[] for _ in means]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        means = [[sum(x) // len(g) for x in zip(*g)] if g else m for g, m in zip(groups, means)]
    return [(i, *reversed(nearest(v))) for i, v in kept], means


def vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, dims))
    return [(i, (middles[i % 5] + spread * rng.normal(size=dims)).astype(np.float32).tolist(), i) for i in range(n)]


def odd(dims):
    same = [0.25] * dims
    return [
        (900, None, 1), (901, [], 1), (902, [1.0] * (dims + 1), 1), (903, [None] + [0.0] * (dims - 1), 1),
        (904, [float("nan")] + [0.0] * (dims - 1), 1), (905, [float("inf")] + [0.0] * (dims - 1), 1),
        (None, same, None), (None, same, 2), (906, same, 1), (906, same, 1), (907, [-3.5] * dims, 0), (908, [90.0] * dims, 0),
    ]


@pytest.mark.parametrize("seed, dims, k, spread", [(1, 4, 8, 0.3), (2, 16, 3, 2.0), (3, 64, 8, 1.0)])
def test_equals_plain_rounds(spark, seed, dims, k, spread):
    rows = vectors(300, dims, seed, spread) + odd(dims) + [(1000 + i, [0.5] * dims, 0) for i in range(150)]
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found, means = centroids.cluster(docs, k=k, rounds=4, dims=dims)
    want, want_means = plain(rows, k, 4, dims)
    assert means == want_means
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_cells_settle_most_vectors_and_never_wrongly():
    rng = np.random.default_rng(7)
    v = rng.integers(-400, 400, size=(2000, 32))
    table = centroids.Cells.of(v[:500], v.min(axis=0), v.max(axis=0))
    cells = table.numbers(v)
    at = np.arange(32)
    assert (table.low[at, cells] <= v).all() and (v <= table.high[at, cells]).all()
    means = np.concatenate([v[:4], v[:1], v[4:7] // 2])  # two equal ones: the smaller number wins
    pivot, sure = centroids.judged(cells, table, means)
    exact = centroids.nearest(v, means)
    assert (pivot[sure] == exact[sure]).all() and sure.mean() > 0.5


def test_wide_values_are_bounded_in_integers():
    v = np.array([[centroids.LARGEST - 1] * 8, [1 - centroids.LARGEST] * 8, [0] * 8])
    table = centroids.Cells.of(v, v.min(axis=0), v.max(axis=0))
    pivot, sure = centroids.judged(table.numbers(v), table, v)
    exact = centroids.nearest(v, v)
    assert (pivot[sure] == exact[sure]).all()


def test_report(spark):
    rows = vectors(60, 64, 5)
    out = centroids.report(spark.createDataFrame(rows, SCHEMA)).collect()
    want, means = plain(rows, 8, 10, 64)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in out) == sorted(want)
    assert {r.inertia for r in out} == {sum(d for *_, d in want)}
    for r in out:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame(vectors(2, 64, 1), SCHEMA)
    assert sorted((r.cluster, r.distance) for r in centroids.report(two).collect()) == [(0, 0), (1, 0)]
    none = centroids.report(two.where("vec_id < 0"))
    assert none.count() == 0
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_columns_of_the_same_names_are_ignored(spark):
    rows = spark.createDataFrame(vectors(30, 64, 2), SCHEMA)
    clash = rows.selectExpr("*", "1 AS cluster", "'x' AS distance", "2 AS row_va", "3 AS inertia", "4 AS v_va")
    assert sorted(centroids.report(clash).collect()) == sorted(centroids.report(rows).collect())


def test_components_that_are_too_large_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1e30] * 64, 1)], SCHEMA)
    with pytest.raises(Exception, match="after scaling"):
        centroids.report(rows).count()
