"""Per-customer features from transactions, web sessions and support tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.numeric import money_mean, money_sum, whole_days


def web_features(sessions: DataFrame) -> DataFrame:
    """Session count and mean pages and time; anonymous sessions are left out."""
    return (
        sessions.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("session_id").alias("web_sessions"),
            F.avg("pages_visited").alias("avg_pages"),
            F.avg("time_on_site").alias("avg_time"),
        )
    )


def support_features(tickets: DataFrame) -> DataFrame:
    """Ticket count, mean satisfaction and mean hours to resolution."""
    return (
        tickets.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("ticket_id").alias("ticket_count"),
            F.avg("satisfaction_score").alias("avg_satisfaction"),
            F.avg("resolution_time_hours").alias("avg_resolution_time"),
        )
    )


def segmentation_features(scored: DataFrame, sessions: DataFrame, tickets: DataFrame) -> DataFrame:
    """Scores and spend with web and support features; a customer without either gets zeros."""
    return (
        scored.select("customer_id", "r_score", "f_score", "m_score", "monetary")
        .join(web_features(sessions), "customer_id", "left")
        .join(support_features(tickets), "customer_id", "left")
        .na.fill(0)
    )


def transaction_features(transactions: DataFrame, as_of: str) -> DataFrame:
    """Spend, order and tenure features per customer as of a given time."""
    now = F.to_timestamp(F.lit(as_of))
    tenure = F.col("tenure_days")
    return (
        transactions.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            money_sum(F.col("amount")).alias("total_spend"),
            money_mean(F.col("amount")).alias("avg_order"),
            F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("std_order"),
            F.count("amount").alias("order_count"),
            F.countDistinct("product_category").alias("category_diversity"),
            whole_days(now, F.min("date")).alias("tenure_days"),
            whole_days(now, F.max("date")).alias("recency_days"),
        )
        .withColumn("purchase_frequency", F.col("order_count") / (F.greatest(tenure, F.lit(1)) / F.lit(30.0)))
    )


def value_features(
    transactions: DataFrame, sessions: DataFrame, tickets: DataFrame, as_of: str
) -> DataFrame:
    """Everything a value model is trained on, one row per buying customer, without nulls."""
    web = web_features(sessions).select(
        "customer_id",
        F.col("web_sessions").alias("total_sessions"),
        "avg_pages",
        F.col("avg_time").alias("avg_time_on_site"),
    )
    support = support_features(tickets).select("customer_id", "ticket_count", "avg_satisfaction")
    return (
        transaction_features(transactions, as_of)
        .join(web, "customer_id", "left")
        .join(support, "customer_id", "left")
        .na.fill(0)
    )
