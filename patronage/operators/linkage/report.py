"""Figures about a resolution run, and the rows given to reviewers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.linkage.pairs import FEATURES


def match_report(records: DataFrame, counts: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: records, matches, clusters, match rate, uncertain pairs, mean cluster size.

    ``counts`` is ``(label, pairs)`` as from ``pair_counts``.
    """
    total = records.agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.agg(
        F.coalesce(F.sum(F.when(F.col("label") == "match", F.col("pairs"))), F.lit(0)).alias("matches"),
        F.coalesce(F.sum(F.when(F.col("label") == "uncertain", F.col("pairs"))), F.lit(0)).alias("uncertain"),
    )
    grouped = clusters.agg(
        F.count(F.lit(1)).alias("clustered"),
        # Every cluster contains the record it is named by, once.
        F.count(F.when(F.col("rec_id") == F.col("component_id"), 1)).alias("groups"),
    )
    row = grouped.select("*", total.scalar().alias("n"), pairs.select(F.struct("*")).scalar().alias("p"))
    return row.select(
        F.col("n").alias("total_records"),
        F.col("p.matches").alias("total_matches"),
        F.col("groups").alias("total_clusters"),
        F.coalesce(F.try_divide("clustered", "n"), F.lit(0.0)).alias("match_rate"),
        F.col("p.uncertain").alias("uncertain_count"),
        (F.col("n") - F.col("clustered")).alias("unmatched_count"),
        F.coalesce(F.try_divide("clustered", "groups"), F.lit(0.0)).alias("avg_cluster_size"),
    )


def review_rows(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Uncertain pairs with id and name of both sides; an unknown record shows its number."""
    who = records.select("rec_id", "customer_id", "name", F.lit(True).alias("known"))

    def side(prefix: str) -> DataFrame:
        return who.select(*[F.col(c).alias(f"{prefix}_{c}") for c in who.columns])

    def shown(prefix: str, key: str) -> list:
        known = F.col(f"{prefix}_known").isNotNull()
        return [
            F.when(known, F.col(f"{prefix}_customer_id")).otherwise(F.col(key).cast("string")).alias(f"{prefix}_id"),
            F.when(known, F.col(f"{prefix}_name")).otherwise(F.lit("")).alias(f"{prefix}_name"),
        ]

    uncertain = pairs.where("label = 'uncertain'").select(
        F.col("left_id").alias("lid"), F.col("right_id").alias("rid"), "score", *FEATURES
    )
    joined = uncertain.join(side("left"), F.col("lid") == F.col("left_rec_id"), "left").join(
        side("right"), F.col("rid") == F.col("right_rec_id"), "left"
    )
    left_id, left_name = shown("left", "lid")
    right_id, right_name = shown("right", "rid")
    return joined.select(
        left_id,
        right_id,
        left_name,
        right_name,
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("score", *FEATURES)],
    )
