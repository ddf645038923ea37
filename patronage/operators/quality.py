"""Data-quality rates of the input tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rate(flag: Column) -> Column:
    """Share of rows where ``flag`` holds; 0 for an empty table."""
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def orphan_transaction_rate(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of transactions whose customer id is null or unknown.

    Transactions are counted per customer id before the join, so an id that
    holds most of the table meets the customers as one row.
    """
    per_id = transactions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    known = customers.where("customer_id IS NOT NULL").select("customer_id").distinct().withColumn("known", F.lit(True))
    joined = per_id.join(known, "customer_id", "left")
    lost = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0))
    return joined.agg(
        F.coalesce(F.try_divide(lost.cast("double"), F.sum("n")), F.lit(0.0)).alias("orphan_transaction_rate")
    )


def missing_email_rate(customers: DataFrame) -> DataFrame:
    return customers.agg(_rate(F.col("email").isNull()).alias("missing_email_rate"))


def duplicate_id_rate(customers: DataFrame) -> DataFrame:
    """Share of customer ids that carry the duplicate marker."""
    marked = F.coalesce(F.col("customer_id").contains("DUP"), F.lit(False))
    return customers.agg(_rate(marked).alias("duplicate_rate"))


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All of the above in one row; the tables are keyed by their usual names."""
    customers = tables["crm_customers"]
    orphans = orphan_transaction_rate(tables["transactions"], customers)
    base = customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        _rate(F.col("email").isNull()).alias("missing_email_rate"),
        _rate(F.coalesce(F.col("customer_id").contains("DUP"), F.lit(False))).alias("duplicate_rate"),
    )
    counts = {
        name: tables[name].agg(F.count(F.lit(1)).alias("n"))
        for name in ("transactions", "web_sessions", "support_tickets")
    }
    return base.select(
        "total_customers",
        "duplicate_rate",
        "missing_email_rate",
        orphans.scalar().alias("orphan_transaction_rate"),
        F.col("total_customers").alias("crm_customers_count"),
        *[df.scalar().alias(f"{name}_count") for name, df in counts.items()],
    )
