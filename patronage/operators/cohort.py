"""Signup cohorts: ages, retention, revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.numeric import MONEY, half_even, month_number


def _signup_months(customers: DataFrame) -> DataFrame:
    return customers.where("customer_id IS NOT NULL").select(
        "customer_id", F.trunc(F.to_date("signup_date"), "MM").alias("cohort_month")
    )


def cohorts(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions with the signup month of the customer and the months since then.

    Purchases before signup have negative ages. Orphans and customers without a
    signup date drop out; a customer listed twice counts twice.
    """
    bought = F.to_date("date")
    return (
        transactions.withColumn("transaction_month", F.trunc(bought, "MM"))
        .join(_signup_months(customers).where("cohort_month IS NOT NULL"), "customer_id")
        .withColumn(
            "cohort_age",
            (month_number(F.col("transaction_month")) - month_number(F.col("cohort_month"))).cast("int"),
        )
    )


def active_customers(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Distinct buyers per ``(cohort_month, cohort_age)``.

    The transactions are cut down to one row per customer and month before the
    join: a customer with most of the purchases brings a few rows to it.
    """
    bought = transactions.select("customer_id", F.trunc(F.to_date("date"), "MM").alias("date")).distinct()
    return count_active(cohorts(customers, bought))


def count_active(cohort_rows: DataFrame) -> DataFrame:
    """The same from the rows of :func:`cohorts`."""
    return cohort_rows.groupBy("cohort_month", "cohort_age").agg(F.countDistinct("customer_id").alias("customers"))


def retention(active: DataFrame) -> DataFrame:
    """Percent of the customers active at age 0, per cohort and age (long form).

    A cohort nobody of which bought in the signup month has no base and drops
    out. Rates above 100 occur when later months have more buyers.
    """
    base = F.max(F.when(F.col("cohort_age") == 0, F.col("customers"))).over(Window.partitionBy("cohort_month"))
    return (
        active.withColumn("cohort_size", base)
        .where("cohort_size IS NOT NULL")
        .select(
            "cohort_month",
            "cohort_age",
            "customers",
            "cohort_size",
            half_even(F.col("customers") / F.col("cohort_size") * 100, 1).alias("retention_rate"),
        )
    )


def retention_matrix(rates: DataFrame, ages: list[int] | None = None) -> DataFrame:
    """One row per cohort, one column per age (``m0``, ``m1``, ``m_1`` for -1); empty cells null.

    ``ages`` fixes the columns; left out, the ages present are looked up, of
    which there are as many as months in the data. A rate of an age that has no
    column is an error.
    """
    present = sorted(r[0] for r in rates.select("cohort_age").distinct().collect())
    if ages is None:
        ages = present
    if missing := sorted(set(present) - set(ages)):
        raise ValueError(f"no column for the ages {missing}")
    wide = rates.groupBy("cohort_month").pivot("cohort_age", ages).agg(F.first("retention_rate"))
    return wide.select(
        "cohort_month", *[F.col(f"`{a}`").alias(f"m{a}" if a >= 0 else f"m_{-a}") for a in ages]
    )


def heatmap_cells(rates: DataFrame) -> DataFrame:
    """``(y, x, z)`` for every cohort and every age seen in any cohort.

    The ages seen ride along as one array per row; there is one per month.
    """
    ages = rates.agg(F.array_sort(F.collect_set("cohort_age")).alias("ages"))
    grid = rates.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(F.struct("cohort_age", "retention_rate"))).alias("rates")
    )
    return grid.select(
        F.date_format("cohort_month", "yyyy-MM").alias("y"),
        F.explode(ages.scalar()).alias("age"),
        "rates",
    ).select(
        "y",
        F.concat(F.lit("Month "), F.col("age").cast("string")).alias("x"),
        F.try_element_at("rates", F.col("age")).alias("z"),
    )


def cohort_metrics(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers, revenue and orders per signup month; no signup date is cohort ``NaT``.

    Transactions are summed per customer before the join; a customer listed
    twice still counts its money twice, as the plain join would.
    """
    per_customer = (
        transactions.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.sum(F.col("amount").cast(MONEY)).alias("spent"), F.count("amount").alias("orders"))
    )
    month = F.coalesce(F.date_format("cohort_month", "yyyy-MM"), F.lit("NaT"))
    sums = (
        _signup_months(customers)
        .join(per_customer, "customer_id")
        .groupBy(month.alias("cohort_month"))
        .agg(
            F.countDistinct("customer_id").alias("unique_customers"),
            F.coalesce(F.sum("spent").cast("double"), F.lit(0.0)).alias("revenue"),
            F.sum("orders").alias("total_orders"),
        )
    )
    revenue = half_even(F.col("revenue"), 2)
    return sums.select(
        "cohort_month",
        "unique_customers",
        revenue.alias("total_revenue"),
        half_even(F.try_divide(F.col("revenue"), F.col("total_orders")), 2).alias("avg_order_value"),
        "total_orders",
        half_even(F.col("total_orders") / F.col("unique_customers"), 2).alias("orders_per_customer"),
        half_even(revenue / F.col("unique_customers"), 2).alias("ltv"),
    )


def average_retention(rates: DataFrame) -> DataFrame:
    """Mean rate per age over the cohorts that have it, each cohort counting once."""
    return rates.groupBy("cohort_age").agg(
        (F.sum(F.col("retention_rate").cast("decimal(18,1)")).cast("double") / F.count("retention_rate")).alias(
            "retention_rate"
        )
    )
