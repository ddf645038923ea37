"""Value tiers and the figures shown about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.numeric import half_even
from patronage.functions.order import group_quantiles, quantiles

TIERS = ("Low Value", "Medium Value", "High Value")


def value_tiers(
    predictions: DataFrame, shares: tuple[float, float] = (0.33, 0.66), id_col: str = "customer_id"
) -> DataFrame:
    """Add ``clv_tier`` by two interpolated quantiles, each tier closed above.

    ``predictions`` is scanned twice; pass a written table.
    """
    low, high = quantiles(predictions, "predicted_clv", id_col, shares)
    if not low < high:
        raise ValueError(f"tier edges coincide or are undefined: {low}, {high}")
    clv = F.col("predicted_clv")
    tier = (
        F.when(clv <= F.lit(low), TIERS[0]).when(clv <= F.lit(high), TIERS[1]).when(clv > F.lit(high), TIERS[2])
    )
    return predictions.withColumn("clv_tier", tier)


def tier_histogram(predictions: DataFrame, bins: int = 50) -> DataFrame:
    """``(clv_tier, bin, customers)`` over ``bins`` equally wide bins of all values, 1 the lowest."""
    clv = F.col("predicted_clv")
    known = predictions.where(clv.isNotNull())
    ends = known.agg(F.min("predicted_clv").alias("low"), F.max("predicted_clv").alias("high")).select(
        F.struct("low", "high").alias("ends")
    )
    placed = known.select("clv_tier", clv.alias("v"), ends.scalar().alias("e"))
    share = F.try_divide(F.col("v") - F.col("e.low"), F.col("e.high") - F.col("e.low"))
    number = F.least(F.lit(bins), F.floor(F.coalesce(share, F.lit(0.0)) * bins).cast("int") + 1)
    return placed.groupBy("clv_tier", number.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))


def tier_totals(predictions: DataFrame) -> DataFrame:
    """Count, mean and sum of the predicted value per tier."""
    return (
        predictions.where("clv_tier IS NOT NULL")
        .groupBy("clv_tier")
        .agg(
            F.count("predicted_clv").alias("customers"),
            half_even(F.avg("predicted_clv"), 2).alias("avg_clv"),
            half_even(F.sum("predicted_clv"), 2).alias("total_clv"),
        )
    )


def tier_describe(predictions: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per tier.

    ``predictions`` is scanned several times; pass a written table.
    """
    quartiles = group_quantiles(predictions, "clv_tier", "predicted_clv", id_col, (0.25, 0.5, 0.75))
    tier = F.col("clv_tier")

    def quartile(i: int):
        # One branch per tier, of which there are three.
        picked = F.lit(None).cast("double")
        for name, values in quartiles.items():
            picked = F.when(tier == name, F.lit(values[i])).otherwise(picked)
        return half_even(picked, 2)

    return (
        predictions.where("clv_tier IS NOT NULL")
        .groupBy("clv_tier")
        .agg(
            F.count("predicted_clv").alias("count"),
            half_even(F.avg("predicted_clv"), 2).alias("mean"),
            half_even(F.stddev_samp("predicted_clv"), 2).alias("std"),
            half_even(F.min("predicted_clv"), 2).alias("min"),
            half_even(F.max("predicted_clv"), 2).alias("max"),
        )
        .select(
            "clv_tier",
            "count",
            "mean",
            "std",
            "min",
            quartile(0).alias("p25"),
            quartile(1).alias("p50"),
            quartile(2).alias("p75"),
            "max",
        )
    )
