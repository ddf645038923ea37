"""Recency, frequency and monetary value: metrics, scores, segments, roll-ups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.numeric import MONEY, half_even, money_sum, whole_days
from patronage.functions.order import order_statistics

# The label of each (recency, frequency, monetary) score triple.
SEGMENT_OF_SCORES = {
    "Champions": ["555", "554", "545"],
    "Loyal Customers": ["455", "544", "445", "444"],
    "Potential Loyalists": ["533", "433", "333"],
    "New Customers": ["511", "411"],
    "Promising": ["311", "322"],
    "Need Attention": ["222", "233"],
    "About to Sleep": ["133", "223"],
    "At Risk": ["122", "123", "211"],
    "Can't Lose Them": ["113", "114", "115"],
    "Hibernating": ["112"],
    "Lost": ["111"],
}


def rfm_metrics(transactions: DataFrame, as_of: str, id_col: str = "customer_id") -> DataFrame:
    """Per customer: days since the last purchase, number of purchases, money spent.

    Orphan ids are customers here too; null ids are nobody's.
    """
    last = F.to_timestamp(F.lit(as_of))
    return (
        transactions.where(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(
            whole_days(last, F.max("date")).alias("recency"),
            F.count("transaction_id").alias("frequency"),
            money_sum(F.col("amount")).alias("monetary"),
        )
    )


def rfm_scores(rfm: DataFrame, n: int = 5, id_col: str = "customer_id") -> DataFrame:
    """Add ``r_score``, ``f_score``, ``m_score`` in 1..n and their text ``rfm_score``.

    Recency is cut at its interpolated quantiles, few days being best. The other
    two are cut by rank, equal values ranked by customer id: a row scores above
    ``k`` when it sorts after the row at rank ``floor(k (N-1) / n) + 1``. So only
    the ``n - 1`` boundary rows are looked up, and the scoring itself is a
    projection. ``rfm`` is scanned several times; pass a written table.
    """
    if n < 2:
        raise ValueError("at least two score classes are needed")
    shares = [k / n for k in range(n + 1)]
    # Whole days take few distinct values, which bounds the state of percentile().
    facts = rfm.agg(
        F.count(F.lit(1)).alias("size"),
        F.percentile("recency", F.array(*[F.lit(s) for s in shares])).alias("edges"),
    ).first()
    if facts["size"] < 2:
        raise ValueError("scores need at least two customers")
    edges = list(facts["edges"])
    if any(a == b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"recency quantiles coincide, {n} classes cannot be formed: {edges}")
    ranks = [math.floor(k * (facts["size"] - 1) / n) + 1 for k in range(1, n)]

    recency = F.lit(1)
    for edge in edges[1:-1]:
        recency = recency + (F.col("recency") <= F.lit(float(edge))).cast("int")
    scored = rfm.withColumn("r_score", recency)
    for metric, score in (("frequency", "f_score"), ("monetary", "m_score")):
        bounds = order_statistics(rfm, [metric, id_col], ranks)
        scored = scored.withColumn(score, _rank_score(metric, id_col, [bounds[r] for r in ranks]))
    return scored.withColumn(
        "rfm_score",
        F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
    )


def _rank_score(metric: str, id_col: str, bounds: list) -> Column:
    score = F.lit(1)
    for row in bounds:
        beyond = (F.col(metric) > F.lit(row[metric])) | (
            (F.col(metric) == F.lit(row[metric])) & (F.col(id_col) > F.lit(row[id_col]))
        )
        score = score + beyond.cast("int")
    return score


def rfm_segments(scored: DataFrame) -> DataFrame:
    """Add ``segment``: the label listed for the score triple, else one by rule."""
    r, f, m = (F.col(c) for c in ("r_score", "f_score", "m_score"))
    triple = F.concat(r.cast("string"), f.cast("string"), m.cast("string"))
    listed = F.lit(None).cast("string")
    for label, triples in SEGMENT_OF_SCORES.items():
        listed = F.when(triple.isin(triples), F.lit(label)).otherwise(listed)
    by_rule = (
        F.when(r >= 4, F.when(f >= 4, "Loyal Customers").otherwise("Potential Loyalists"))
        .when(r <= 2, F.when(m >= 4, "Can't Lose Them").otherwise("At Risk"))
        .otherwise("Need Attention")
    )
    return scored.withColumn("segment", F.coalesce(listed, by_rule))


def segment_summary(segmented: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Size, averages and shares per segment, largest revenue first.

    Shares are taken of the rounded totals.
    """
    per_segment = segmented.groupBy("segment").agg(
        F.count(id_col).alias("customer_count"),
        half_even(F.avg("recency"), 2).alias("avg_recency"),
        half_even(F.avg("frequency"), 2).alias("avg_frequency"),
        half_even(F.sum(F.col("monetary").cast(MONEY)).cast("double") / F.count("monetary"), 2).alias("avg_monetary"),
        half_even(money_sum(F.col("monetary")), 2).alias("total_monetary"),
    )
    # Unpartitioned, but over one row per segment: eleven labels at most.
    everyone = Window.partitionBy()
    return per_segment.select(
        "*",
        half_even(F.col("customer_count") / F.sum("customer_count").over(everyone) * 100, 1).alias("pct_customers"),
        half_even(
            F.try_divide(F.col("total_monetary"), F.sum("total_monetary").over(everyone)) * 100, 1
        ).alias("pct_revenue"),
    ).orderBy(F.desc("total_monetary"), "segment")


def segment_overview(scores: DataFrame) -> DataFrame:
    """Unrounded averages per segment, richest average first, with the implied revenue."""
    mean_money = F.sum(F.col("monetary").cast(MONEY)).cast("double") / F.count("monetary")
    return (
        scores.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            mean_money.alias("avg_monetary"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("recency").alias("avg_recency"),
        )
        .withColumn("total_revenue", F.col("customer_count") * F.col("avg_monetary"))
        .orderBy(F.desc("avg_monetary"), "segment")
    )
