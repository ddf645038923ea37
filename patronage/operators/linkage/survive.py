"""Golden records: one row per customer with the best value of each field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.order import numbered
from patronage.functions.text import digits

# Source ids in one row of the comma lists.
IDS_PER_LIST = 1000


def unified_id(rec_id: Column) -> Column:
    """Zero-padded to six places, longer ids in full."""
    return F.format_string("GOLD_%06d", rec_id)


def _earliest(rec_id: str) -> Column:
    return -F.col(rec_id)


def best_name(name: str = "name", rec_id: str = "rec_id") -> Column:
    """Aggregate: the longest name, the first of equally long ones."""
    order = F.when(F.col(name).isNotNull(), F.struct(F.length(name), _earliest(rec_id)))
    return F.max_by(name, order)


def best_email(email: str = "email", rec_id: str = "rec_id") -> Column:
    """Aggregate: the first email with an ``@``, else the first email."""
    proper = F.min_by(email, F.when(F.col(email).contains("@"), F.col(rec_id)))
    present = F.min_by(email, F.when(F.col(email).isNotNull(), F.col(rec_id)))
    return F.coalesce(proper, present)


def best_phone(phone: str = "phone", rec_id: str = "rec_id") -> Column:
    """Aggregate: the phone with the most digits, in its own format, the first on ties."""
    order = F.when(F.col(phone).isNotNull(), F.struct(F.length(digits(F.col(phone))), _earliest(rec_id)))
    return F.max_by(phone, order)


def crosswalk(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(rec_id, customer_id, unified_id)`` for every record; the whole lineage in long form."""
    return with_components(records, clusters).select(
        "rec_id", "customer_id", unified_id(F.col("component_id")).alias("unified_id")
    )


def with_components(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """Records with their component; a record without a match is its own."""
    return records.join(clusters, "rec_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "rec_id")
    )


def lineage(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(unified_id, position, rec_id, customer_id)``: the members of every cluster of any size, by ``rec_id``."""
    rows = with_components(records, clusters).select("component_id", "rec_id", "customer_id")
    return numbered(rows, "component_id", "rec_id").select(
        unified_id(F.col("component_id")).alias("unified_id"), "position", "rec_id", "customer_id"
    )


def golden_records(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row per cluster and per unmatched record; its members are in :func:`lineage`."""
    return (
        with_components(records, clusters)
        .groupBy("component_id")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            best_name().alias("name"),
            best_email().alias("email"),
            best_phone().alias("phone"),
        )
        .select(unified_id(F.col("component_id")).alias("unified_id"), "name", "email", "phone", "record_count")
    )


def source_id_lists(members: DataFrame, per_list: int = IDS_PER_LIST) -> DataFrame:
    """``(unified_id, part, source_ids)``: all members in comma lists of ``per_list`` ids, in order.

    A small cluster has one list; a large one as many as it takes.
    """
    part = F.floor((F.col("position") - 1) / per_list).cast("int")
    return (
        members.groupBy("unified_id", part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "customer_id"))).alias("listed"))
        .select(
            "unified_id", "part", F.array_join(F.transform("listed", lambda x: x["customer_id"]), ",").alias("source_ids")
        )
    )


def split_source_ids(lists: DataFrame) -> DataFrame:
    """``(customer_id, unified_id)`` read back from comma lists, blanks dropped."""
    return (
        lists.select("unified_id", F.explode(F.split("source_ids", ",")).alias("part"))
        .select(F.trim("part").alias("customer_id"), "unified_id")
        .where("customer_id <> ''")
    )
