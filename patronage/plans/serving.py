"""Look-ups and roll-ups over the written result tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.numeric import half_even


def _joined(golden: DataFrame, scores: DataFrame, predictions: DataFrame, how: str, extra: list[str]) -> DataFrame:
    r = scores.select(F.col("customer_id").alias("unified_id"), "rfm_score", "segment", *extra)
    c = predictions.select(F.col("customer_id").alias("unified_id"), "predicted_clv", "clv_tier")
    return (
        golden.select("unified_id", "name", "email")
        .join(r, "unified_id", how)
        .join(c, "unified_id", "left")
        .select("unified_id", "name", "email", "rfm_score", "segment", *extra, "predicted_clv", "clv_tier")
    )


GRAM = 3
_SEARCHED = ("name", "email", "unified_id")


def _grams(text: Column) -> Column:
    """The distinct runs of ``GRAM`` characters of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - GRAM + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.array_distinct(F.when(F.char_length(text) >= GRAM, runs))


def search_index(golden: DataFrame) -> DataFrame:
    """Inverted lists ``(field, gram, unified_id, value)`` of the searched texts in lower case, to be written as they come.

    Sorted by field and gram, so that a filter on both reads the parts of the files that hold these lists. The
    range cut takes the id too: a gram that most texts have spreads over many files.
    """
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in _SEARCHED])
    rows = golden.select("unified_id", F.explode(fields).alias("f")).select("unified_id", "f.*")
    lists = rows.select("field", F.explode(_grams(F.lower("value"))).alias("gram"), "unified_id", "value")
    return lists.repartitionByRange("field", "gram", "unified_id").sortWithinPartitions("field", "gram", "unified_id")


def _contains(value: Column, text: str, any_case: bool) -> Column:
    pattern = F.lit(f"%{text}%")
    if any_case:
        value, pattern = F.lower(value), F.lower(pattern)
    return F.like(value, pattern, F.lit("\x01"))


def asked_grams(text: str) -> list[str]:
    """The runs that every match has: those of the parts between wildcards, in lower case.

    A letter whose lower case depends on its neighbours or has another length makes no run.
    """
    runs = []
    for part in re.split("[%_]", text):
        lowered = [c.lower() if len(c.lower()) == 1 and c not in "\u03a3\u03c3\u03c2" else None for c in part]
        runs += [lowered[i : i + GRAM] for i in range(len(lowered) - GRAM + 1)]
    return sorted({"".join(r) for r in runs if None not in r})


def found_by_index(index: DataFrame, text: str) -> DataFrame | None:
    """``unified_id`` of the customers that match, from the lists of ``text`` alone; None if it has no run to look up.

    A customer has to be in every list of one field; its text there is verified.
    """
    grams = asked_grams(text)
    if not grams:
        return None
    lists = index.where(F.col("field").isin(*_SEARCHED) & F.col("gram").isin(*grams))
    named = (
        lists.groupBy("field", "unified_id")
        .agg(F.count(F.lit(1)).alias("n"), F.first("value").alias("value"))
        .where(F.col("n") == len(grams))
    )
    matched = F.lit(False)
    for field in _SEARCHED:
        matched = matched | ((F.col("field") == field) & _contains(F.col("value"), text, field != "unified_id"))
    return named.where(matched).select("unified_id").distinct()


def search_customers(
    golden: DataFrame, scores: DataFrame, predictions: DataFrame, text: str, limit: int = 50, index: DataFrame | None = None
) -> DataFrame:
    """Customers whose name or email contains ``text`` in any case, or whose id contains it as is.

    ``%`` and ``_`` in the text are wildcards, a backslash is itself. The first ``limit`` by id, which
    are picked before the joins. With ``index``, a written :func:`search_index`, only the lists
    of the text are read to pick them; texts without a run of three characters scan.
    """
    ids = found_by_index(index, text) if index is not None else None
    if ids is None:
        hit = [_contains(F.col(c), text, c != "unified_id") for c in _SEARCHED]
        ids = golden.where(hit[0] | hit[1] | hit[2]).select("unified_id")
    picked = [r[0] for r in ids.orderBy("unified_id").limit(limit).collect()]  # at most ``limit`` ids
    own = F.col("unified_id").isin(picked)
    found = golden.where(own)
    return _joined(
        found, scores.where(F.col("customer_id").isin(picked)), predictions.where(F.col("customer_id").isin(picked)), "left", []
    ).orderBy("unified_id")


def customer_profile(
    golden: DataFrame, scores: DataFrame, predictions: DataFrame, unified_id: str, members: DataFrame | None = None
) -> DataFrame:
    """The golden row of one customer with its scores and value; the id filters every side.

    With ``members``, the lineage, the row lists the customer's own ``source_ids``.
    """
    wanted = F.lit(unified_id)
    if members is not None:
        own = members.where(F.col("unified_id") == wanted).groupBy("unified_id").agg(
            F.array_sort(F.collect_list(F.struct("position", "customer_id"))).alias("listed")
        )
        ids = F.array_join(F.transform("listed", lambda x: x["customer_id"]), ",")
        golden = golden.join(own.select("unified_id", ids.alias("source_ids")), "unified_id", "left")
    r = scores.where(F.col("customer_id") == wanted).withColumnRenamed("customer_id", "unified_id")
    c = predictions.where(F.col("customer_id") == wanted).select(
        F.col("customer_id").alias("unified_id"), "predicted_purchases", "predicted_clv", "clv_tier"
    )
    return (
        golden.where(F.col("unified_id") == wanted).join(r, "unified_id", "left").join(c, "unified_id", "left")
    )


def recent_activity(
    rows: DataFrame, walk: DataFrame, newest: Column, tie: str, columns: list[str], limit: int
) -> DataFrame:
    """The newest ``limit`` rows of every unified customer, ties by id.

    Cut to ``limit`` per customer id first, then per unified customer. Spark
    applies a rank limit in the map tasks too, so an id with most of the rows
    sends ``limit`` of them per task and meets the crosswalk with that many.
    """

    def cut(df: DataFrame, key: str) -> DataFrame:
        order = Window.partitionBy(key).orderBy(newest.desc(), F.col(tie))
        return df.withColumn("recent_rank", F.row_number().over(order)).where(F.col("recent_rank") <= limit)

    kept = cut(rows.where("customer_id IS NOT NULL"), "customer_id").drop("recent_rank")
    owned = kept.join(walk.select("customer_id", "unified_id"), "customer_id")
    return cut(owned, "unified_id").select("unified_id", "recent_rank", *columns)


def recent_transactions(transactions: DataFrame, walk: DataFrame, limit: int = 20) -> DataFrame:
    return recent_activity(
        transactions, walk, F.col("date"), "transaction_id", ["date", "amount", "product_category"], limit
    )


def recent_sessions(sessions: DataFrame, walk: DataFrame, limit: int = 10) -> DataFrame:
    return recent_activity(
        sessions,
        walk,
        F.col("timestamp"),
        "session_id",
        ["timestamp", "pages_visited", "time_on_site", "referrer"],
        limit,
    )


def recent_tickets(tickets: DataFrame, walk: DataFrame, limit: int = 10) -> DataFrame:
    return recent_activity(
        tickets,
        walk,
        F.col("created_at"),
        "ticket_id",
        ["created_at", "category", "satisfaction_score", "status"],
        limit,
    )


def resolution_statistics(customers: DataFrame, golden: DataFrame) -> DataFrame:
    """Records before and after, percent removed, records per customer."""
    after = golden.agg(F.count(F.lit(1)).alias("n"))
    n, g = F.col("original_records"), F.col("unified_records")
    return customers.agg(F.count(F.lit(1)).alias("original_records")).select(
        "original_records", after.scalar().alias("unified_records")
    ).select(
        "*",
        half_even(F.coalesce((F.lit(1.0) - F.try_divide(g, n)) * 100, F.lit(0.0)), 1).alias("dedup_rate_pct"),
        half_even(F.try_divide(n, g), 2).alias("avg_cluster_size"),
    )


def segments(scores: DataFrame) -> DataFrame:
    return scores.select("segment").distinct().orderBy("segment")


def segment_members(golden: DataFrame, scores: DataFrame, predictions: DataFrame, segment: str) -> DataFrame:
    """The customers of one segment with scores, spend and value."""
    chosen = scores.where(F.col("segment") == F.lit(segment))
    return _joined(golden, chosen, predictions, "inner", ["monetary"])
