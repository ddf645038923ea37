"""Many K-Means fits in one set of passes.

Every pass reads the points once for all fits that still move: an Arrow batch is
measured against the centres of all of them, and each task gives back sums and
counts per centre. Fits whose centres stand still leave. So the number of
passes is that of the slowest fit, whatever the number of ``(k, start)``.

Starts are k-means++ on a sample of ``SAMPLE_ROWS`` points (the smallest hashes
of their ids), moved there until they settle; all further steps are over all points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2_000
BLOCK_ROWS = 1_024
DIRECT = 16

# A block of rows -> numbers to be added over all blocks.
Figures = Callable[[pa.RecordBatch], np.ndarray]


def total(rows: DataFrame, figures: Figures, columns: Sequence[str], parts: int | None = None) -> np.ndarray:
    """The sum of ``figures`` over all rows: one job, in which each task sends one row.

    With more than ``DIRECT`` tasks (``parts``; None: not known) their rows are
    added up in ``DIRECT`` groups before they come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                value = figures(batch.slice(start, BLOCK_ROWS))
                added = value if added is None else added + value
        if added is not None:
            yield _sent(added)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = None
        for batch in batches:
            for value in batch.column(0):
                value = value.values.to_numpy()
                added = value if added is None else added + value
        if added is not None:
            yield _sent(added)

    sent = rows.select(*columns).mapInArrow(run, "added array<double>")
    if parts is None or parts > DIRECT:
        sent = sent.repartition(DIRECT).mapInArrow(merge, "added array<double>")
    return sum((v.values.to_numpy() for v in sent.toArrow().column(0)), 0.0)


def _sent(added: np.ndarray) -> pa.RecordBatch:
    flat = pa.array(added, pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)], names=["added"]
    )


def matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of equal length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fits:
    """Centres of several fits, stacked, with the borders between them."""

    def __init__(self, centres: Sequence[np.ndarray]):
        self.borders = np.cumsum([0, *[len(c) for c in centres]])
        self.stacked = np.concatenate(centres)

    def _groups(self) -> list[tuple[int, int, int]]:
        """Runs of fits with equally many centres: first centre, fits, centres of each."""
        found = []
        for first, k in zip(self.borders, np.diff(self.borders)):
            if found and found[-1][2] == k:
                found[-1][1] += 1
            else:
                found.append([int(first), 1, int(k)])
        return [tuple(f) for f in found]

    def _measured(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per group the squared distances less the point's own square, by fit, centre and point, and the least by fit and point.

        One group at a time, so that its distances stay in the core's cache while they are used.
        """
        # Points run along the last axis, so that all that follows works on long rows.
        across = np.ascontiguousarray(x.T)
        norms = (self.stacked * self.stacked).sum(axis=1)[:, None]
        for centre, fits, k in self._groups():
            some = slice(centre, centre + fits * k)
            distance = self.stacked[some] @ across
            distance *= -2.0
            distance += norms[some]
            own = distance.reshape(fits, k, len(x))
            yield own, own.min(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per point and fit the number of the nearest centre in the stack (of equally near ones the first), and the squared distance to it."""
        norms = (x * x).sum(axis=1)
        measured = [(own.argmin(axis=1), np.maximum(least + norms, 0.0)) for own, least in self._measured(x)]
        number = np.concatenate([n for n, _ in measured]).T + self.borders[:-1]
        return number, np.concatenate([least for _, least in measured]).T

    def figures(self, x: np.ndarray) -> np.ndarray:
        """Sums and counts per centre, then the squared distances per fit."""
        padded = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        norms = (x * x).sum(axis=1)
        sums, inertia = [], []
        for own, least in self._measured(x):
            near = own == least[:, None, :]
            if np.count_nonzero(near) != least.size:  # of equally near centres the first
                near &= np.cumsum(near, axis=1) == 1
            np.copyto(own, near)
            sums.append(own.reshape(-1, len(x)) @ padded)
            inertia.extend(np.maximum(least + norms, 0.0).sum(axis=1))
        added = np.concatenate(sums)
        return np.concatenate([added[:, :-1].ravel(), added[:, -1], inertia])

    def step(self, added: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The next centres, how far each fit's have moved (squared), and its inertia before the move.

        A centre without points stays where it is.
        """
        n, d = self.stacked.shape
        sums, counts, inertia = added[: n * d].reshape(n, d), added[n * d : n * d + n], added[n * d + n :]
        new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1.0)[:, None], self.stacked)
        moved = np.add.reduceat(((new - self.stacked) ** 2).sum(axis=1), self.borders[:-1])
        return [new[a:b] for a, b in zip(self.borders, self.borders[1:])], moved, inertia


def spread_starts(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each centre a point drawn by its squared distance from those before."""
    centres = [sample[rng.integers(len(sample))]]
    for _ in range(k - 1):
        apart = np.min([((sample - c) ** 2).sum(axis=1) for c in centres], axis=0)
        chances = apart / apart.sum() if apart.sum() > 0 else None
        centres.append(sample[rng.choice(len(sample), p=chances)])
    return np.array(centres)


def settle(measure: Callable[[Fits], np.ndarray], centres: list[np.ndarray], tolerance: float, max_iter: int):
    """Move all fits together until none moves by more than ``tolerance``; returns centres, inertias and passes."""
    centres, inertias = list(centres), np.full(len(centres), np.inf)
    moving, passes = list(range(len(centres))), 0
    while moving and passes < max_iter:
        fits = Fits([centres[i] for i in moving])
        new, moved, inertia = fits.step(measure(fits))
        passes += 1
        for i, c, value in zip(moving, new, inertia):
            centres[i], inertias[i] = c, value
        moving = [i for i, by in zip(moving, moved) if by > tolerance]
    return centres, inertias, passes


@dataclass(frozen=True)
class Sweep:
    """The best fit of every k."""

    centres: dict[int, np.ndarray]
    inertias: dict[int, float]
    passes: int


def sweep(
    points: DataFrame,
    id_column: str,
    ks: Sequence[int],
    seed: int,
    starts: int,
    max_iter: int,
    tolerance: float = 1e-4,
    parts: int | None = None,
) -> Sweep:
    """For each k the fit with the smallest within-cluster sum over several starts, settled to the last digits.

    ``tolerance`` is the squared move of all centres of a fit at which a start counts
    as done, as a share of the mean variance of the components; the best start of each k goes on
    until no centre moves any more.
    """
    drawn = points.orderBy(F.xxhash64(F.lit(seed), id_column), id_column).limit(SAMPLE_ROWS).select("x").collect()
    sample = np.array([r["x"] for r in drawn])
    tolerance *= float(sample.var(axis=0).mean())
    rng = np.random.default_rng(seed)
    runs = [k for k in ks for _ in range(starts)]
    begun = [spread_starts(sample, k, rng) for k in runs]
    begun, _, _ = settle(lambda fits: fits.figures(sample), begun, tolerance, max_iter)

    def measure(fits: Fits) -> np.ndarray:
        return total(points, lambda batch: fits.figures(matrix(batch.column(0))), ["x"], parts)

    centres, inertias, passes = settle(measure, begun, tolerance, max_iter)
    best = {k: min((i for i, of in enumerate(runs) if of == k), key=lambda i: (inertias[i], i)) for k in ks}
    final, _, more = settle(measure, [centres[best[k]] for k in ks], 1e-18, max_iter)
    inertia = measure(Fits(final))[-len(ks) :]
    return Sweep(dict(zip(ks, final)), dict(zip(ks, map(float, inertia))), passes + more + 1)


def cluster_number(x: Sequence[Column], centres: np.ndarray) -> Column:
    """The number of the nearest centre as an expression; of equally near ones the first."""
    found = F.array_min(
        F.array(
            *[
                F.struct(
                    sum(((value - F.lit(float(c))) * (value - F.lit(float(c))) for value, c in zip(x, centre)), F.lit(0.0)).alias("d"),
                    F.lit(number).alias("number"),
                )
                for number, centre in enumerate(centres)
            ]
        )
    )
    return found["number"].cast("int")


def labelled_figures(
    points: DataFrame, labels: str | Fits, sizes: Sequence[int], parts: int | None = None
) -> tuple[list[float], list[float]]:
    """Inertia and silhouette of several labellings at once, in two passes.

    ``labels`` is an array column with a label from 0 to ``sizes[j] - 1`` for each
    labelling j, or fits, whose nearest centres are the labels. The silhouette uses squared Euclidean distances; the mean one to a
    cluster follows from its count, sum and sum of squares. A point alone in its cluster has silhouette 0, and
    one cluster alone gives -1.
    """
    begin = np.cumsum([0, *sizes])
    width = int(begin[-1])

    columns = ["x"] if isinstance(labels, Fits) else ["x", labels]

    def labelled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = matrix(batch.column(0))
        return x, labels.nearest(x)[0] - labels.borders[:-1] if isinstance(labels, Fits) else matrix(batch.column(1))

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, numbers = labelled(batch)
        chosen = np.zeros((len(x), width))
        chosen[np.arange(len(x))[:, None], numbers + begin[:-1]] = 1.0
        return np.concatenate([(chosen.T @ x).ravel(), chosen.T @ (x * x).sum(axis=1), chosen.sum(axis=0)])

    found = total(points, moments, columns, parts)
    sums, squares, counts = found[: -2 * width].reshape(width, -1), found[-2 * width : -width], found[-width:]
    around = np.maximum(counts, 1.0)
    inertia = squares - (sums * sums).sum(axis=1) / around

    def apart(batch: pa.RecordBatch) -> np.ndarray:
        x, numbers = labelled(batch)
        norms = (x * x).sum(axis=1)[:, None]
        mean = norms + squares / around - 2.0 * (x @ (sums / around[:, None]).T)
        out = []
        for j, (a, b) in enumerate(zip(begin, begin[1:])):
            own = numbers[:, j][:, None]
            size = counts[a:b][own[:, 0]]
            inside = np.take_along_axis(mean[:, a:b], own, axis=1)[:, 0] * size / np.maximum(size - 1.0, 1.0)
            others = np.where(counts[a:b] > 0, mean[:, a:b], np.inf)
            np.put_along_axis(others, own, np.inf, axis=1)
            outside = others.min(axis=1)
            largest = np.maximum(inside, outside)
            value = np.where((size > 1) & (largest > 0), (outside - inside) / np.where(largest > 0, largest, 1.0), 0.0)
            out.append(float(value.sum()) if np.isfinite(outside).all() else -float(len(x)))
        return np.array(out)

    n = counts[: sizes[0]].sum()
    return [float(inertia[a:b].sum()) for a, b in zip(begin, begin[1:])], (total(points, apart, columns, parts) / n).tolist()
