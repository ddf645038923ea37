"""Columns of the four input tables, and the check made when one enters a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRM_CUSTOMERS = T.StructType(
    [
        T.StructField("rec_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("segment", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("zip_code", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("product_category", T.StringType()),
    ]
)

WEB_SESSIONS = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("pages_visited", T.IntegerType()),
        T.StructField("time_on_site", T.IntegerType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("pages_path", T.StringType()),
    ]
)

SUPPORT_TICKETS = T.StructType(
    [
        T.StructField("ticket_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("resolution_time_hours", T.DoubleType()),
        T.StructField("satisfaction_score", T.IntegerType()),
        T.StructField("status", T.StringType()),
    ]
)

INPUTS = {
    "crm_customers": CRM_CUSTOMERS,
    "transactions": TRANSACTIONS,
    "web_sessions": WEB_SESSIONS,
    "support_tickets": SUPPORT_TICKETS,
}


# Columns whose amounts are summed as decimals of two places.
MONEY_COLUMNS = {"transactions": ("amount",)}


def _two_places(amount: Column, name: str) -> Column:
    """The amount, or an error where it has more than two decimals, as those would be lost in exact sums."""
    scaled = amount * 100
    fine = F.abs(scaled - F.rint(scaled)) <= 1e-3
    message = F.concat(F.lit(f"{name} has more than two decimals: "), amount.cast("string"))
    return F.when(amount.isNull() | fine, amount).otherwise(F.raise_error(message).cast("double"))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns with the declared types; fail on a missing one and on amounts of more than two decimals."""
    schema = INPUTS[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    columns = {f.name: df[f.name].cast(f.dataType) for f in schema.fields}
    for name in MONEY_COLUMNS.get(table, ()):
        columns[name] = _two_places(columns[name], name)
    return df.select([c.alias(name) for name, c in columns.items()])
