"""Purchase summaries the value models are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.numeric import MONEY, whole_days


def purchase_summary(transactions: DataFrame, method: str = "library", id_col: str = "customer_id") -> DataFrame:
    """Repeat customers: ``(frequency, recency, T, monetary_value)``, times in days.

    ``library``: purchases of one day are one purchase, frequency counts the
    days after the first, the value is the mean of those days. ``simple``:
    frequency is the number of rows less one, the value the mean of all rows.
    T runs to the last day anybody bought.
    """
    bought = transactions.where(F.col(id_col).isNotNull()).select(
        F.col(id_col), F.col("date"), F.col("amount").cast(MONEY).alias("amount")
    )
    if method == "library":
        return _by_day(bought, id_col)
    if method == "simple":
        return _by_row(bought, id_col)
    raise ValueError(f"unknown method {method!r}")


def _by_day(bought: DataFrame, id_col: str) -> DataFrame:
    daily = bought.groupBy(id_col, F.to_date("date").alias("day")).agg(F.sum("amount").alias("spent"))
    last_day = bought.agg(F.max(F.to_date("date")).alias("d"))
    return summary_of_days(daily, last_day, id_col)


def summary_of_days(daily: DataFrame, last_day: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """The ``library`` summary from one row per customer and day with the money ``spent``.

    ``last_day`` is a one-row frame with the last day of the observation.
    """
    return (
        daily.groupBy(id_col)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.min("day").alias("first"),
            F.max("day").alias("last"),
            F.sum("spent").alias("total"),
            F.min_by("spent", "day").alias("opening"),
        )
        .where("days > 1")
        .select(
            id_col,
            (F.col("days") - 1).alias("frequency"),
            F.datediff("last", "first").cast("long").alias("recency"),
            F.datediff(last_day.scalar(), "first").cast("long").alias("T"),
            ((F.col("total") - F.col("opening")).cast("double") / (F.col("days") - 1)).alias("monetary_value"),
        )
    )


def _by_row(bought: DataFrame, id_col: str) -> DataFrame:
    last = bought.agg(F.max("date").alias("d"))
    return (
        bought.groupBy(id_col)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("date").alias("first"),
            F.max("date").alias("last"),
            F.sum("amount").cast("double").alias("total"),
            F.count("amount").alias("paid"),
        )
        .where("n > 1")
        .select(
            id_col,
            (F.col("n") - 1).alias("frequency"),
            whole_days(F.col("last"), F.col("first")).alias("recency"),
            whole_days(last.scalar(), F.col("first")).alias("T"),
            F.try_divide("total", "paid").alias("monetary_value"),
        )
    )


def heuristic_value(summary: DataFrame, months: int = 12) -> DataFrame:
    """Purchases at the past rate over ``months`` of 30 days, times the mean value.

    Null where T is 0: the rate is undefined.
    """
    rate = F.try_divide(F.col("frequency").cast("double"), F.col("T"))
    purchases = F.when(rate.isNotNull(), F.greatest(F.lit(0.0), rate * F.lit(months) * F.lit(30)))
    return summary.withColumn("predicted_purchases", purchases).withColumn(
        "predicted_clv", F.col("predicted_purchases") * F.col("monetary_value")
    )
