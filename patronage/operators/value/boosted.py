"""Boosted regression of customer value on features: the final model and all folds in one set of passes.

Features are cut once into at most ``BINS`` bins, a byte each. Rows are kept in blocks: the codes
feature by feature, and the residual of every model. A pass over the blocks gives, for every model, node and
feature, sums and counts of residuals per bin. The tasks' sums of a model are added up in one task, which picks the
splits; the driver gets the nodes of the trees and no sums. All models (one on the training
rows, one per fold) share every pass.

A pass covers several levels of a tree at once: a sample of ``SAMPLE_ROWS`` rows on the
driver proposes them, the pass tells for each node, from the top, whether
the proposed split is the best one over all rows. Where it is not, the node gets
the best one, the sample proposes anew what hangs below it, and the next pass
goes on from there, over the levels that are open. It looks one level further than the last one could settle. So
the trees are those of level-wise growth over all rows, in
one to ``depth`` passes each; a sample that holds all rows always needs one.
The residuals after a tree are kept in memory, and written every ``KEEP_TREES`` trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.session import full_rounds, shuffles_removed, written

ID = "customer_id"

BINS = 128
SAMPLE_ROWS = 40_000
KEEP_TREES = 8
ROWS_EACH = 200_000


def bucket(buckets: int, salt: int) -> Column:
    """A bucket that depends on the customer alone: the first 32 bits of a SHA-256, modulo ``buckets``."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(ID)).cast("binary"), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


@dataclass
class Tree:
    """A tree in heap order, node i above 2 i + 1 (up to the bin) and 2 i + 2; ``feature`` is -1 in leaves."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes), np.zeros(nodes))

    def below(self, codes: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        """The nodes of rows (the columns of ``codes``) one level below ``level``; rows in leaves stay."""
        down = at.copy()
        for node in range(2**level - 1, 2 ** (level + 1) - 1):
            if self.feature[node] >= 0:
                step = (codes[self.feature[node]] > self.bin[node]).astype(at.dtype) + at.dtype.type(node + 1)
                down += (at == node) * step
        return down

    def predict(self, codes: np.ndarray) -> np.ndarray:
        """The values of rows, which are the columns of ``codes``."""
        at = np.zeros(codes.shape[1], np.int16)
        for level in range(int(np.log2(len(self.value) + 1)) - 1):
            at = self.below(codes, at, level)
        return self.value[at]


def level_sums(tree: Tree, fixed: int, end: int, codes: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """``(node, feature, bin, (sum, count))`` for all nodes of level ``fixed``, then the left children of each level before ``end``."""
    width, n = codes.shape
    out, at = [], np.zeros(n, np.int16)
    for level in range(end):
        if level >= fixed:
            place = at - (2**level - 1)
            here = place >= 0
            slots = 2**level
            if level > fixed:
                here &= place % 2 == 0
                place, slots = place // 2, slots // 2
            rows = np.flatnonzero(here)
            first, weight = place[rows].astype(np.intp) * BINS, residual[rows]
            sums = np.empty((slots, width, BINS, 2))
            for f in range(width):
                key = first + codes[f][rows]
                sums[:, f, :, 0] = np.bincount(key, weight, slots * BINS).reshape(slots, BINS)
                sums[:, f, :, 1] = np.bincount(key, minlength=slots * BINS).reshape(slots, BINS)
            out.append(sums)
        if level + 1 < end:
            at = tree.below(codes, at, level)
    return np.concatenate(out)


def _split(sums: np.ndarray, proposed: tuple[int, int] | None):
    """``feature, bin, gain`` of the best split of a node, feature -1 if none gains; of equal ones the proposed, else the first."""
    total_sum, total_n = sums[0].sum(axis=0)
    left = sums.cumsum(axis=1)[:, :-1]
    ls, ln = left[..., 0], left[..., 1]
    rn = total_n - ln
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((ln > 0) & (rn > 0), ls**2 / ln + (total_sum - ls) ** 2 / rn, -np.inf)
    if total_n < 2:
        return -1, 0, 0.0
    gain = gain - total_sum**2 / total_n
    best = int(np.argmax(gain))
    top = gain.flat[best]
    # Less than rounding of the sums can make up is no gain.
    if not top > 1e-9 * (1.0 + total_sum**2 / total_n):
        return -1, 0, 0.0
    # Gains this close are equal but for the order in which residuals were added up.
    near = 1e-6 * top + 1e-12 * float(np.max(np.where(np.isfinite(gain), gain, 0.0) + total_sum**2 / total_n))
    if proposed is not None and proposed[0] >= 0 and gain[proposed] >= top - near:
        return *proposed, float(gain[proposed])
    return *divmod(best, gain.shape[1]), float(top)


def confirm(tree: Tree, fixed: int, end: int, sums: np.ndarray, proposal: Tree) -> int:
    """Settle the levels of ``tree`` from ``fixed`` on with the sums of a pass over ``proposal`` up to ``end``.

    Returns the number of levels that are settled; below the first split that differs from
    the proposed one nothing is known yet.
    """
    first = 2**fixed - 1
    # Nodes below leaves have no rows.
    known = {n: sums[n - first] for n in range(first, 2 * first + 1) if not n or tree.feature[(n - 1) // 2] >= 0}
    settled, offset = end, 2**fixed
    for level in range(fixed, end):
        first = 2**level - 1
        for node in range(first, 2 * first + 1):
            if node not in known:
                continue
            own = known[node]
            g, n = own[0].sum(axis=0)
            tree.value[node] = g / n if n else 0.0
            guess = int(proposal.feature[node]), int(proposal.bin[node])
            tree.feature[node], tree.bin[node], tree.gain[node] = _split(own, guess)
            if tree.feature[node] < 0:
                continue
            f, b = int(tree.feature[node]), int(tree.bin[node])
            ls, ln = own[f, : b + 1].sum(axis=0)
            for child, s, c in ((2 * node + 1, ls, ln), (2 * node + 2, g - ls, n - ln)):
                tree.value[child] = s / c if c else 0.0
            if (f, b) != guess:
                settled = min(settled, level + 1)
            elif level + 1 < end:
                place = offset + node - first
                known[2 * node + 1] = sums[place]
                known[2 * node + 2] = own - sums[place]
        offset += 2**level
    open_from = 2**settled - 1
    tree.feature[open_from:], tree.gain[open_from:] = -1, 0.0
    return settled


def propose(tree: Tree, fixed: int, end: int, codes: np.ndarray, residual: np.ndarray) -> Tree:
    """The tree that the sample would grow up to level ``end``, with the first ``fixed`` levels as they are."""
    made = Tree(tree.feature.copy(), tree.bin.copy(), tree.value.copy(), tree.gain.copy())
    for level in range(fixed, end):
        sums = level_sums(made, level, level + 1, codes, residual)
        for place, own in enumerate(sums):
            node = 2**level - 1 + place
            made.feature[node], made.bin[node], made.gain[node] = _split(own, None)
    return made


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: start value, rate, trees, and the bins' upper ends per feature."""

    columns: list[str]
    edges: list[np.ndarray]
    start: float
    rate: float
    trees: list[Tree] = field(repr=False)

    def values(self, codes: np.ndarray) -> np.ndarray:
        turned = np.ascontiguousarray(codes.T)
        return self.start + self.rate * sum((t.predict(turned) for t in self.trees), np.zeros(len(codes)))

    def transform(self, features: DataFrame) -> DataFrame:
        """``features`` with a column ``prediction``."""
        names = [*features.columns, "prediction"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(batch.num_columns - 1))
                value = self.values(codes_of(x, self.edges))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(value)], names=names)

        x = F.array(*[F.col(c).cast("double") for c in self.columns]).alias("_x")
        kinds = T.StructType([*features.schema.fields, T.StructField("prediction", T.DoubleType())])
        return features.select(*features.columns, x).mapInArrow(run, kinds)


@dataclass(frozen=True)
class BoostedFit:
    """A fitted model with its hold-out errors, cross-validated R², importances, and the predictions behind them.

    ``predictions``: ``customer_id, label, prediction, held_out, fold, fold_prediction``, the
    last from the model that has not seen the row's fold.
    """

    model: BoostedTrees
    mae: float
    r2: float
    cv_r2: float | None
    importance: list[tuple[str, float]]
    predictions: DataFrame
    passes: int

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.mae, self.r2, self.cv_r2)], "mae double, r2 double, cv_scores double"
        )

    def importance_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.importance, "feature string, importance double")


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def codes_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of every value: up to the edge is its own bin; missing values are above all."""
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def bin_edges(sample: np.ndarray) -> list[np.ndarray]:
    """Upper ends of all bins but the last: every value of the sample if they are few, else quantiles.

    The last bin, above the largest value of the sample, is that of missing values.
    """
    edges = []
    for column in sample.T:
        known = column[~np.isnan(column)]
        values = np.unique(known)
        if len(values) >= BINS:
            values = np.unique(np.quantile(known, np.arange(1, BINS) / (BINS - 1), method="lower"))
        edges.append(values)
    return edges


def errors(predicted: DataFrame, prediction: str = "prediction") -> tuple[float, float]:
    """Mean absolute error and R² of ``label`` against ``prediction``; R² is undefined (NaN) for equal labels."""
    off = F.col("label") - F.col(prediction)
    row = predicted.agg(
        F.avg(F.abs(off)).alias("mae"), F.avg(off * off).alias("mse"), F.var_pop("label").alias("variance")
    ).first()
    if row["mae"] is None:
        return float("nan"), float("nan")
    return row["mae"], 1.0 - row["mse"] / row["variance"] if row["variance"] else float("nan")


class Booster:
    """Boosting of several models over the same blocks ``codes, models, residuals``; bit m of ``models``: trains model m."""

    def __init__(self, blocks: DataFrame, sample, n_models: int, depth: int, rate: float):
        self.state, self.depth, self.rate, self.m = blocks, depth, rate, n_models
        self.sample_codes, self.sample_in, self.sample_residuals = sample
        self.ahead = [depth] * n_models
        self.passes = 0

    def _measure(self, trees: list[Tree], settled: list[int], proposals: dict[int, tuple[Tree, int]]) -> None:
        """One pass: settles what it can of ``trees``, whose open levels ``proposals`` has up to a level each."""
        m = self.m

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for codes, models, residuals in _blocks_of(batches, m):
                for j, (proposal, end) in proposals.items():
                    own = (models >> j) & 1 == 1
                    c, r = (codes, residuals[j]) if own.all() else (codes[:, own], residuals[j, own])
                    found = level_sums(proposal, settled[j], end, c, r)
                    sums[j] = sums[j] + found if j in sums else found
            for j, found in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["model", "sums"])

        def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for j, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = np.frombuffer(raw.as_buffer(), float)
                    sums[j] = sums[j] + found if j in sums else found
            for j, found in sums.items():
                proposal, end = proposals[j]
                tree = trees[j]
                done = confirm(tree, settled[j], end, found.reshape(-1, width, BINS, 2), proposal)
                arrays = [pa.array([v.tolist()], pa.list_(k)) for v, k in zip((tree.feature, tree.bin, tree.value, tree.gain), kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([done], pa.int32()), *arrays], names=names)

        width = len(self.sample_codes)
        names = ["model", "settled", "feature", "bin", "value", "gain"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        self.passes += 1
        # The sums of a pass go once it has ended: on disk they would add up over all passes.
        with shuffles_removed(self.state.sparkSession):
            sent = self.state.mapInArrow(added, "model int, sums binary").repartition(min(m, len(proposals)), "model")
            rows = sent.mapInArrow(picked, "model int, settled int, feature array<long>, bin array<long>, value array<double>, gain array<double>")
            found = rows.toArrow().to_pylist()
        for row in found:
            j = row["model"]
            trees[j] = Tree(np.array(row["feature"]), np.array(row["bin"]), np.array(row["value"]), np.array(row["gain"]))
            self.ahead[j] = row["settled"] - settled[j] + 1
            settled[j] = row["settled"]

    def add_tree(self) -> list[Tree]:
        """The next tree of every model, whose values the residuals then lack."""
        trees = [Tree.empty(self.depth) for _ in range(self.m)]
        settled = [0] * self.m
        while min(settled) < self.depth:
            proposals = {}
            for j in range(self.m):
                if settled[j] < self.depth:
                    own, end = self.sample_in[:, j], min(self.depth, settled[j] + self.ahead[j])
                    made = propose(trees[j], settled[j], end, self.sample_codes[:, own], self.sample_residuals[j, own])
                    proposals[j] = made, end
            self._measure(trees, settled, proposals)
        m, rate = self.m, self.rate

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left = [
                    (residuals - rate * np.stack([t.predict(codes) for t in trees])).tobytes()
                    for codes, _, residuals in _blocks_of([batch], m)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(left, pa.binary())], names=batch.schema.names)

        self.state = self.state.mapInArrow(run, self.state.schema)
        self.sample_residuals -= rate * np.stack([t.predict(self.sample_codes) for t in trees])
        return trees


def _blocks_of(batches, m: int):
    """Codes (a row per feature), models and residuals (a row per model) of every block."""
    for batch in batches:
        for codes, models, residuals in zip(*[batch.column(i) for i in range(3)]):
            own = np.frombuffer(models.as_buffer(), np.int64)
            yield (
                np.frombuffer(codes.as_buffer(), np.uint8).reshape(-1, len(own)), own,
                np.frombuffer(residuals.as_buffer(), float).reshape(m, -1),
            )


def fit_boosted(
    features: DataFrame,
    target: str | Column,
    folds: int | None = 5,
    trees: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    seed: int = 42,
) -> BoostedFit:
    """Train on four fifths, measure on the rest, and cross-validate over all rows.

    ``target`` is a column of ``features`` or an expression over them; every
    column but the id is a feature. ``folds=None`` leaves out the cross-validation.
    Writes and runs jobs when called.
    """
    names = [c for c in features.columns if c != ID]
    label = F.col(target) if isinstance(target, str) else target
    x = F.array(*[F.col(c).cast("double") for c in names])
    base = written(
        features.select(ID, x.alias("x"), label.cast("double").alias("y"), bucket(5, seed).alias("part")), "training"
    )
    rows = base.count()
    folds = 0 if folds is None else min(folds, rows)
    m = 1 + folds
    parts = full_rounds(features.sparkSession, rows, ROWS_EACH)
    fold = bucket(folds, seed + 1) if folds else F.lit(None).cast("int")
    trains = (F.col("part") > 0).cast("int")
    for j in range(folds):
        trains = trains + F.when(F.col("fold") != j, 1 << (j + 1)).otherwise(0)
    marked = base.withColumn("fold", fold).withColumn("models", trains.cast("long"))
    sizes = marked.agg(
        *[F.avg(F.when(F.col("models").bitwiseAND(1 << j) != 0, F.col("y"))).alias(f"m{j}") for j in range(m)]
    ).first()
    if any(v is None for v in sizes):
        raise ValueError("a model has no training row")
    starts = np.array([float(v) for v in sizes])

    drawn = marked.orderBy(F.xxhash64(F.lit(seed), ID), ID).limit(SAMPLE_ROWS).select("x", "y", "models").toArrow()
    drawn = drawn.combine_chunks().to_batches()[0]
    seen, models = _matrix(drawn.column(0)), drawn.column(2).to_numpy(zero_copy_only=False)
    edges = bin_edges(seen)
    sample = (
        np.ascontiguousarray(codes_of(seen, edges).T), np.stack([(models >> j) & 1 == 1 for j in range(m)], axis=1),
        drawn.column(1).to_numpy(zero_copy_only=False) - starts[:, None],
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(_matrix(batch.column(0)), edges).T.tobytes()
                y, models = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                block = codes, models.astype(np.int64).tobytes(), (y - starts[:, None]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in block], names=["codes", "models", "residuals"])

    dealt = marked.select(ID, "x", "y", "models").repartition(parts, ID).select("x", "y", "models")
    blocks = written(dealt.mapInArrow(encode, "codes binary, models binary, residuals binary"), "boosted-blocks")
    booster = Booster(blocks.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK), sample, m, depth, rate)
    grown: list[list[Tree]] = [[] for _ in range(m)]
    before: DataFrame | None = None
    for t in range(trees):
        kept = booster.state
        for own, tree in zip(grown, booster.add_tree()):
            own.append(tree)
        # The passes have read what is kept; what it was made from is not needed any more.
        if before is not None:
            before.unpersist()
        before = kept
        if (t + 1) % KEEP_TREES == 0 and t + 1 < trees:
            booster.state = written(booster.state, "boosted-state").coalesce(parts)
        booster.state = booster.state.persist(StorageLevel.MEMORY_AND_DISK)
    booster.state.unpersist()
    if before is not None:
        before.unpersist()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.ascontiguousarray(codes_of(_matrix(batch.column(1)), edges).T)
            fold = np.array(batch.column(4).fill_null(-1).to_numpy(zero_copy_only=False), int)
            value = starts[0] + rate * sum((t.predict(codes) for t in grown[0]), np.zeros(len(fold)))
            other = np.zeros(len(fold))
            for j in np.unique(fold[fold >= 0]):
                own = fold == j
                other[own] = starts[j + 1] + rate * sum((t.predict(codes[:, own]) for t in grown[j + 1]), np.zeros(own.sum()))
            own_fold = pa.array(other, mask=fold < 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(value), batch.column(3), batch.column(4), own_fold], names=shown
            )

    shown = [ID, "label", "prediction", "held_out", "fold", "fold_prediction"]
    kind = base.schema[ID].dataType.simpleString()
    predictions = written(
        marked.select(ID, "x", "y", (F.col("part") == 0).alias("held_out"), "fold").mapInArrow(
            predict, f"{ID} {kind}, label double, prediction double, held_out boolean, fold int, fold_prediction double"
        ),
        "boosted-predictions",
    )
    mae, r2 = errors(predictions.where("held_out"))
    cv = None
    if folds:
        off = F.col("label") - F.col("fold_prediction")
        per = predictions.groupBy("fold").agg((1 - F.avg(off * off) / F.nullif(F.var_pop("label"), F.lit(0.0))).alias("r2"))
        cv = per.agg(F.avg("r2")).first()[0]
    weights = np.zeros(len(names))
    for tree in grown[0]:
        split = tree.feature >= 0
        gains = np.bincount(tree.feature[split], weights=tree.gain[split], minlength=len(names))
        weights += gains / gains.sum() if gains.sum() else 0.0
    weights = weights / weights.sum() if weights.sum() else weights
    importance = sorted(zip(names, map(float, weights)), key=lambda pair: (-pair[1], pair[0]))
    model = BoostedTrees(names, edges, float(starts[0]), rate, grown[0])
    return BoostedFit(model, mae, r2, cv, importance, predictions, booster.passes)
