"""Fitting a handful of positive parameters by distributed sums of likelihoods and their gradients.

Parameter vectors to try travel to the tasks with the function. Every Arrow
batch of observations gives, per vector, one sum of log likelihoods and one of
each derivative; Spark adds those up. A step of the search tries several
lengths along one direction, with their gradients, so it is one job, and only
as many numbers as there are lengths and parameters come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (parameters, observations as columns of one batch) -> log likelihood of each, and its derivatives by parameter
Likelihood = Callable[[np.ndarray, dict[str, np.ndarray]], tuple[np.ndarray, list[np.ndarray]]]

# A scaled parameter beyond these has left what the data can tell.
LEAST, LARGEST = 1e-4, 1e4


@dataclass(frozen=True)
class Certificate:
    """How a search ended: largest derivative by a log parameter, steps, and parameters that ran to 0 or infinity."""

    gradient: float
    steps: int
    at_boundary: bool


class Objective:
    """Minus the mean log likelihood plus a ridge penalty, over log parameters.

    ``counts`` holds distinct observations with their number in ``n``.
    """

    def __init__(self, counts: DataFrame, likelihood: Likelihood, penalty: float):
        self.counts = counts
        self.likelihood = likelihood
        self.penalty = penalty

    def at(self, points: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Objective and gradient at each point; infinite where it is undefined."""
        likelihood, trials = self.likelihood, np.exp(np.asarray(points))

        def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = {c: batch[c].to_numpy(dtype=float) for c in batch.columns}
                sums = []
                with np.errstate(all="ignore"):
                    for t in trials:
                        value, slopes = likelihood(t, rows)
                        sums.append([float(np.sum(v * rows["n"])) for v in (value, *slopes)])
                out = pd.DataFrame(sums, columns=["ll", *[f"g{j}" for j in range(trials.shape[1])]])
                yield out.assign(i=range(len(trials)), n=rows["n"].sum())

        names = ["ll", *[f"g{j}" for j in range(trials.shape[1])], "n"]
        kinds = ", ".join(f"{c} double" for c in names[:-1])
        added = (
            self.counts.mapInPandas(partial_sums, f"{kinds}, i int, n double")
            .groupBy("i")
            .agg(*[F.sum(c).alias(c) for c in names])
            .collect()
        )
        values, gradients = np.full(len(trials), np.inf), np.zeros(trials.shape)
        for row in added:
            sums = np.array([np.nan if row[c] is None else row[c] for c in names[:-1]])
            if np.isfinite(sums).all():
                theta = trials[row["i"]]
                values[row["i"]] = -sums[0] / row["n"] + self.penalty * np.sum(theta**2)
                gradients[row["i"]] = theta * (-sums[1:] / row["n"] + 2.0 * self.penalty * theta)
        return values, gradients


def minimise(
    objective: Objective, start: Sequence[float], tolerance: float = 1e-6, max_steps: int = 100, reach: float = 2.0
) -> tuple[np.ndarray, Certificate]:
    """Quasi-Newton steps (BFGS) until no derivative exceeds ``tolerance``; the parameters and how the search ended.

    A search that runs out of steps, or on which nothing gains while a derivative is still
    a hundred times ``tolerance``, is an error.
    """
    x = np.log(np.asarray(start, dtype=float))
    d = len(x)
    lengths = np.array([1.0, 3.0, 0.5, 0.2, 0.05, 0.01, 0.001])
    shorter = np.array([0.3, 0.1, 1e-2, 1e-3, 1e-4, 1e-5, 1e-6])
    values, gradients = objective.at([x])
    f, g = values[0], gradients[0]
    if not np.isfinite(f):
        raise ArithmeticError("the likelihood is undefined at the start")
    inverse, fresh = np.eye(d), True
    for step in range(1, max_steps + 1):
        if np.max(np.abs(g)) < tolerance:
            theta = np.exp(x)
            return theta, Certificate(float(np.max(np.abs(g))), step - 1, bool(((theta < LEAST) | (theta > LARGEST)).any()))
        way = -inverse @ g
        longest = np.max(np.abs(way))
        if longest > reach:
            way *= reach / longest
        lengths_now = lengths
        values, gradients = objective.at([x + t * way for t in lengths])
        best = int(np.argmin(values))
        if not values[best] < f:
            if fresh:
                if np.max(np.abs(g)) < 100 * tolerance:  # as far as doubles go
                    theta = np.exp(x)
                    return theta, Certificate(float(np.max(np.abs(g))), step, bool(((theta < LEAST) | (theta > LARGEST)).any()))
                # Where the objective bends much, all of these lengths lie beyond the valley.
                lengths_now = lengths[-1] * shorter
                values, gradients = objective.at([x + t * way for t in lengths_now])
                best = int(np.argmin(values))
                if not values[best] < f:
                    raise ArithmeticError(f"no step gains, but the gradient is {np.max(np.abs(g)):.2g}")
            else:
                inverse, fresh = np.eye(d), True
                continue
        moved, turned = lengths_now[best] * way, gradients[best] - g
        x, f, g = x + moved, values[best], gradients[best]
        bend = float(moved @ turned)
        if bend > 1e-14:
            if fresh:
                inverse = np.eye(d) * (bend / float(turned @ turned))
            left = np.eye(d) - np.outer(moved, turned) / bend
            inverse, fresh = left @ inverse @ left.T + np.outer(moved, moved) / bend, False
    raise ArithmeticError(f"no convergence within {max_steps} steps")


def better_neighbours(
    objective: Objective, parameters: Sequence[float], by: float = 0.01, tolerance: float = 1e-7
) -> int:
    """How many of the points a share ``by`` away along each parameter have an objective smaller by ``tolerance``.

    The tolerance is what a derivative that counts as vanished gains over such a distance, tenfold.
    """
    x = np.log(np.asarray(parameters, dtype=float))
    around = [x, *[x + s * np.log1p(by) * e for e in np.eye(len(x)) for s in (1, -1)]]
    values, _ = objective.at(around)
    return int((values[1:] < values[0] - tolerance).sum())
