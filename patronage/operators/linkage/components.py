"""Clusters of records connected by matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from patronage.operators.linkage.normalise import forms_of, members, profiles
from patronage.operators.linkage.pairs import copy_scores, profile_pairs
from patronage.operators.linkage.rules import MatchRules
from patronage.session import remove, written, written_at


def connected_components(edges: DataFrame, left: str = "left_id", right: str = "right_id") -> DataFrame:
    """``(rec_id, component_id)`` for every id in an edge; the smallest id names the component.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond", SoCC 2014), O(log² n) rounds of one
    aggregation and one join each. Each round's edges are written to the shared
    folder, and the same job counts and hashes them; no change ends the loop.
    """
    spark = edges.sparkSession
    u, v = F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    step = edges.where(F.col(left) != F.col(right)).select(u, v).distinct()
    current, before, temporary = None, None, []
    while True:
        # Every round reads its edges several times: they are written, and counted on the way.
        seen = Observation()
        step = step.observe(
            seen, F.count(F.lit(1)).alias("edges"), F.bit_xor(F.xxhash64("u", "v")).alias("digest")
        )
        current, path = written_at(step, "edges")
        for old in temporary:
            remove(spark, old)
        temporary = [path]
        after = (seen.get["edges"], seen.get["digest"])
        if after == before or after[0] == 0:
            break
        before = after

        def hold(part: DataFrame) -> DataFrame:
            # A join with an aggregate is not split at run time when a node is hot; with a table it is.
            table, where = written_at(part, "star")
            temporary.append(where)
            return table

        step = _small_star(hold(_large_star(current, hold)), hold)
    roots = current.select(F.col("v").alias("rec_id"), F.col("v").alias("component_id")).distinct()
    return current.select(F.col("u").alias("rec_id"), F.col("v").alias("component_id")).unionByName(roots)


def _large_star(edges: DataFrame, hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = hold(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame, hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = hold(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def match_clusters(records: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """``(rec_id, component_id)`` of all records with a match, straight from the records.

    Works on profiles: the copies of a profile never enter the graph, they take
    the component of their profile. Record pairs are not formed.
    """
    forms = written(forms_of(records, rules.blocking), "forms")
    distinct = written(profiles(forms), "profiles")
    matches = profile_pairs(distinct, rules, rules.match_threshold)
    linked = connected_components(matches).withColumnRenamed("rec_id", "profile_id")
    selves = (
        copy_scores(distinct, rules)
        .where(F.col("score") >= rules.match_threshold)
        .select("profile_id", F.lit(True).alias("self"))
    )
    labels = written(
        linked.join(selves, "profile_id", "full").select(
            "profile_id", F.coalesce("component_id", "profile_id").alias("component_id")
        ),
        "labels",
    )
    return members(forms, distinct).join(labels, "profile_id").select("rec_id", "component_id")
