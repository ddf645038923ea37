"""Buying and spending models: BG/NBD and Gamma-Gamma, and the value they predict.

Fader, Hardie, Lee, "Counting Your Customers the Easy Way" (2005); Fader,
Hardie, "The Gamma-Gamma Model of Monetary Value" (2013).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions.numeric import digamma, log_gamma
from patronage.operators.value.fitting import Certificate, Objective, better_neighbours, minimise
from patronage.session import full_rounds, written

DAYS_PER_MONTH = 30


@dataclass(frozen=True)
class BuyingModel:
    """BG/NBD parameters, times in days, and how the fit that gave them ended."""

    r: float
    alpha: float
    a: float
    b: float
    fit: Certificate | None = field(default=None, compare=False)

    def frame(self, spark: SparkSession) -> DataFrame:
        return _parameters(spark, self, ("r", "alpha", "a", "b"))


@dataclass(frozen=True)
class SpendModel:
    """Gamma-Gamma parameters, and how the fit that gave them ended."""

    p: float
    q: float
    v: float
    fit: Certificate | None = field(default=None, compare=False)

    def frame(self, spark: SparkSession) -> DataFrame:
        return _parameters(spark, self, ("p", "q", "v"))


def _parameters(spark: SparkSession, model: BuyingModel | SpendModel, names: tuple[str, ...]) -> DataFrame:
    """``parameter, value`` with the gradient, steps and boundary flag of the fit beside each."""
    fit = model.fit
    end = (fit.gradient, fit.steps, fit.at_boundary) if fit else (None, None, None)
    rows = [(n, getattr(model, n), *end) for n in names]
    return spark.createDataFrame(rows, "parameter string, value double, gradient double, steps int, at_boundary boolean")


# The frequencies of the last batch, and what :func:`_counts` found in them. The batch itself is the caller's.
_last_counts: tuple = (None, None)


def _counts(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct frequencies of a batch, and which of them each row has; found once for all parameters tried."""
    global _last_counts
    batch, found = _last_counts
    if batch is not rows["frequency"]:
        found = np.unique(rows["frequency"], return_inverse=True)
        _last_counts = rows["frequency"], found
    return found


def buying_likelihood(parameters: np.ndarray, rows: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log likelihood of ``(frequency, recency, T)`` under ``(r, alpha, a, b)``, and its derivatives."""
    r, alpha, a, b = parameters
    x, t_x, age = rows["frequency"], rows["recency"], rows["T"]
    # What depends on the frequency alone, for each frequency once.
    k, at = _counts(rows)
    k_last = b + np.maximum(k, 1.0) - 1.0
    counts = (log_gamma(r + k) - log_gamma(r) + r * np.log(alpha))[at]
    drops = (log_gamma(a + b) + log_gamma(b + k) - log_gamma(b) - log_gamma(a + b + k))[at]
    both = digamma(a + b) - digamma(a + b + k)
    rise = (digamma(r + k) - digamma(r) + np.log(alpha))[at]
    log_last, last = np.log(k_last)[at], k_last[at]
    log_age, log_last_buy = np.log(alpha + age), np.log(alpha + t_x)
    alive = -(r + x) * log_age
    gone = np.log(a) - log_last - (r + x) * log_last_buy
    either = np.where(x > 0, np.logaddexp(alive, gone), alive)
    left = np.where(x > 0, np.exp(gone - either), 0.0)  # chance of having dropped out
    slopes = [
        rise - (1 - left) * log_age - left * log_last_buy,
        r / alpha - (r + x) * ((1 - left) / (alpha + age) + left / (alpha + t_x)),
        both[at] + left / a,
        (both + digamma(b + k) - digamma(b))[at] - left / last,
    ]
    return counts + drops + either, slopes


def spend_likelihood(parameters: np.ndarray, rows: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log likelihood of a mean ``monetary_value`` over ``frequency`` purchases under ``(p, q, v)``, and its derivatives."""
    p, q, v = parameters
    x, m = rows["frequency"], rows["monetary_value"]
    pooled, log_m = np.log(x * m + v), np.log(m)
    # What depends on the frequency alone, for each frequency once.
    k, at = _counts(rows)
    fixed = (log_gamma(p * k + q) - log_gamma(p * k) - log_gamma(q) + q * np.log(v))[at]
    value = fixed + (p * x - 1.0) * log_m + (p * k * np.log(k))[at] - (p * x + q) * pooled
    both, log_k = digamma(p * k + q), np.log(k)
    slopes = [
        x * ((both - digamma(p * k))[at] + log_m + log_k[at] - pooled),
        (both - digamma(q) + np.log(v))[at] - pooled,
        q / v - (p * x + q) / (x * m + v),
    ]
    return value, slopes


def _counted(summary: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct observations with their number, kept for the many passes of a fit."""
    distinct = written(
        summary.groupBy(*[F.col(c).cast("double").alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("n")),
        "observations",
    )
    # Dealt evenly over all cores, whatever files they came in: a pass waits for its longest task.
    parts = full_rounds(summary.sparkSession, distinct.count())
    return distinct.repartition(parts, *columns).persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def buying_objective(summary: DataFrame, penalty: float, longest_age: float) -> Iterator[tuple[Objective, float]]:
    """The objective over times scaled so that the oldest customer has age ``longest_age``, and the scale."""
    oldest = summary.agg(F.max("T")).first()[0]
    if not oldest:
        raise ValueError("no customer with a positive age")
    unit = longest_age / float(oldest)
    counts = _counted(summary, ["frequency", "recency", "T"])
    try:
        scaled = counts.withColumn("recency", F.col("recency") * unit).withColumn("T", F.col("T") * unit)
        yield Objective(scaled, buying_likelihood, penalty), unit
    finally:
        counts.unpersist()


@contextmanager
def spend_objective(summary: DataFrame, penalty: float) -> Iterator[tuple[Objective, float]]:
    """The objective over money scaled to mean 1, so that the penalty does not depend on the currency, and that mean.

    Repeat customers without positive spend have no likelihood and are an error.
    """
    repeat = summary.where("frequency > 0")
    row = repeat.agg(
        F.avg("monetary_value").alias("mean"), F.count_if(~F.coalesce(F.col("monetary_value") > 0, F.lit(False))).alias("bad")
    ).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} repeat customers have no positive spend")
    if not row["mean"]:
        raise ValueError("no repeat customer")
    counts = _counted(repeat, ["frequency", "monetary_value"])
    try:
        scaled = counts.withColumn("monetary_value", F.col("monetary_value") / row["mean"])
        yield Objective(scaled, spend_likelihood, penalty), row["mean"]
    finally:
        counts.unpersist()


def fit_buying(summary: DataFrame, penalty: float = 0.01, longest_age: float = 10.0) -> BuyingModel:
    """Penalised maximum likelihood fit of BG/NBD.

    The penalty acts on the scaled alpha, which is scaled back at the end. A
    parameter that ran to 0 or infinity shows in ``fit.at_boundary``.
    """
    with buying_objective(summary, penalty, longest_age) as (objective, unit):
        (r, alpha, a, b), fit = minimise(objective, [1.0, 1.0, 1.0, 1.0])
    return BuyingModel(float(r), float(alpha / unit), float(a), float(b), fit)


def fit_spend(summary: DataFrame, penalty: float = 0.01) -> SpendModel:
    """Penalised maximum likelihood fit of Gamma-Gamma on repeat customers.

    A fit with q <= 1, which gives customers no expected spend, is an error.
    """
    with spend_objective(summary, penalty) as (objective, mean):
        (p, q, v), fit = minimise(objective, [1.0, 2.0, 1.0])
    if q <= 1:
        raise ArithmeticError(f"q = {q:.3g}: the expected spend is not finite")
    return SpendModel(float(p), float(q), float(v * mean), fit)


def certified(
    summary: DataFrame, model: BuyingModel | SpendModel, penalty: float = 0.01, longest_age: float = 10.0
) -> DataFrame:
    """One row ``customers, converged, better_neighbours`` on a fitted model.

    ``converged``: no derivative by a log parameter above 1e-4, worked out anew; ``better_neighbours``: how many
    points 1 % away along one parameter fit better.
    """
    if isinstance(model, BuyingModel):
        opened = buying_objective(summary, penalty, longest_age)
    else:
        opened = spend_objective(summary, penalty)
    with opened as (objective, scale):
        if isinstance(model, BuyingModel):
            at = [model.r, model.alpha * scale, model.a, model.b]
        else:
            at = [model.p, model.q, model.v / scale]
        _, gradients = objective.at([np.log(at)])
        customers = int(objective.counts.agg(F.sum("n")).first()[0])
        row = customers, bool(np.max(np.abs(gradients)) < 1e-4), better_neighbours(objective, at)
    return summary.sparkSession.createDataFrame([row], "customers long, converged boolean, better_neighbours int")


def likelihoods(summary: DataFrame, model: BuyingModel | SpendModel) -> DataFrame:
    """``customer_id, log_likelihood`` of each customer's history under given parameters."""
    if isinstance(model, BuyingModel):
        names, parameters, of = ["frequency", "recency", "T"], (model.r, model.alpha, model.a, model.b), buying_likelihood
    else:
        names, parameters, of = ["frequency", "monetary_value"], (model.p, model.q, model.v), spend_likelihood

    @F.pandas_udf("double")
    def log_likelihood(columns: pd.DataFrame) -> pd.Series:
        rows = {n: columns[n].to_numpy(float) for n in names}
        return pd.Series(of(np.array(parameters), rows)[0])

    return summary.select("customer_id", log_likelihood(F.struct(*names)).alias("log_likelihood"))


def _hyp2f1(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Power series of 2F1 for 0 <= z < 1, to full precision."""
    total = np.ones_like(z)
    term = np.ones_like(z)
    for n in range(100_000):
        term = term * ((a + n) * (b + n) / ((c + n) * (n + 1)) * z)
        total += term
        if np.all(np.abs(term) <= 1e-15 * np.abs(total)):
            return total
    raise ArithmeticError("the hypergeometric series does not settle")


def _expected_purchases(model: BuyingModel, x, t_x, age, horizons: np.ndarray) -> np.ndarray:
    """E[purchases within each horizon], shape (customers, horizons).

    Euler's transformation turns the paper's 2F1(r+x, b+x; ...) into one with
    small parameters times a power of 1-z, which cancels the large power around it.
    """
    x, t_x, age = (np.asarray(v, dtype=float)[:, None] for v in (x, t_x, age))
    r, alpha, b = model.r, model.alpha, model.b

    def at(a: float) -> np.ndarray:
        z = horizons[None, :] / (alpha + age + horizons[None, :])
        c = a + b + x - 1.0
        inner = (1.0 - z) ** (a - 1.0) * _hyp2f1(a + b - 1.0 - r, a - 1.0, c + np.zeros_like(z), z)
        dead = np.where(x > 0, a / (b + np.maximum(x, 1.0) - 1.0), 0.0)
        dead = dead * ((alpha + age) / (alpha + t_x)) ** (r + x)
        return c / (a - 1.0) * (1.0 - inner) / (1.0 + dead)

    # a = 1 is a removable singularity: take the mean of both sides.
    near = 1e-5
    if abs(model.a - 1.0) < near:
        return (at(1.0 - near) + at(1.0 + near)) / 2.0
    return at(model.a)


def predict_value(
    summary: DataFrame, buying: BuyingModel, spend: SpendModel, months: int = 12, discount_rate: float = 0.01
) -> DataFrame:
    """Add ``predicted_purchases`` over the horizon and the discounted ``predicted_clv``.

    The purchases of month k are E[Y(30 k)] - E[Y(30 (k-1))], valued at the
    expected spend and discounted by ``(1 + discount_rate) ** k``.
    """
    ends = np.arange(1, months + 1, dtype=float) * DAYS_PER_MONTH
    discount = (1.0 + discount_rate) ** np.arange(1, months + 1)

    @F.pandas_udf("predicted_purchases double, discounted_purchases double")
    def forecast(x: pd.Series, t_x: pd.Series, age: pd.Series) -> pd.DataFrame:
        upto = _expected_purchases(buying, x, t_x, age, ends)
        monthly = np.diff(upto, axis=1, prepend=0.0)
        return pd.DataFrame(
            {"predicted_purchases": upto[:, -1], "discounted_purchases": (monthly / discount).sum(axis=1)}
        )

    x, m = F.col("frequency"), F.col("monetary_value")
    spent = spend.p * (spend.v + x * m) / (spend.p * x + (spend.q - 1.0))
    ahead = summary.withColumn("_f", forecast("frequency", "recency", "T"))
    return ahead.select(
        *summary.columns,
        F.col("_f.predicted_purchases").alias("predicted_purchases"),
        (F.col("_f.discounted_purchases") * spent).alias("predicted_clv"),
    )
