"""Exact order statistics and quantiles of frames of any size.

The built-in exact ``percentile`` holds one counter per distinct value in one
task, and a ranking window without a partition key runs in one task. Here a
mergeable quantile sketch tells between which two values each wanted rank must
lie, one more pass counts the rows below and within these brackets, and only the rows
within are sorted: range partitions, a count for each, and a fetch of the rows at the
wanted places. The sketch decides what is fetched, not the result.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.session import remove, shared_folder, written, written_at

# monotonically_increasing_id keeps the partition above bit 33, the position below.
_POSITION_BITS = 33

# A rank of the sketch is off by at most one in so many rows.
SKETCH_ACCURACY = 10_000


def order_statistics(df: DataFrame, order: Sequence[str], ranks: Iterable[int]) -> dict[int, Row]:
    """Rows at the given 1-based ranks when ``df`` is sorted by ``order``.

    End ``order`` with a unique column: equal values then spread over
    partitions instead of piling up in one.
    """
    wanted = sorted(set(ranks))
    if not wanted:
        return {}
    rows = df.select(*order)
    if not isinstance(df.schema[order[0]].dataType, T.NumericType):
        return _sorted_places(rows, order, {r: r for r in wanted})
    n = rows.count()
    if wanted[0] < 1 or wanted[-1] > n:
        raise ValueError(f"rank {wanted[0] if wanted[0] < 1 else wanted[-1]} is outside the frame")
    brackets = _brackets(rows, F.col(order[0]), wanted, n)
    value = F.col(order[0])
    counts = rows.agg(
        *[F.count_if(value < F.lit(low)).alias(f"b{i}") for i, (low, _) in enumerate(brackets)],
        *[F.count_if(value.between(F.lit(low), F.lit(high))).alias(f"i{i}") for i, (low, high) in enumerate(brackets)],
    ).first()
    places, before = {}, 0  # rank in the frame -> rank among the rows of all brackets
    for i in range(len(brackets)):
        below, inside = counts[f"b{i}"], counts[f"i{i}"]
        places |= {r: r - below + before for r in wanted if below < r <= below + inside}
        before += inside
    within = F.lit(False)
    for low, high in brackets:
        within = within | value.between(F.lit(low), F.lit(high))
    return _sorted_places(rows.where(within), order, places)


def _brackets(rows: DataFrame, value: Column, wanted: Sequence[int], n: int) -> list[tuple]:
    """Disjoint ranges of values, ascending, in which the wanted ranks lie for certain."""
    slack = 2.0 / SKETCH_ACCURACY
    shares = [min(1.0, max(0.0, s)) for r in wanted for s in ((r - 1) / n - slack, r / n + slack)]
    ends = rows.agg(F.percentile_approx(value, shares, SKETCH_ACCURACY)).first()[0]
    merged: list[list] = []
    for low, high in sorted(zip(ends[::2], ends[1::2])):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [tuple(m) for m in merged]


def _sorted_places(rows: DataFrame, order: Sequence[str], wanted: dict[int, int]) -> dict[int, Row]:
    """The rows at the places ``wanted`` (name -> 1-based place) of the sorted rows."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from a sample, so a second evaluation could cut elsewhere:
    # the places are fixed by a table before they are counted.
    placed, path = written_at(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "order-places",
    )
    part = F.shiftright("_place", _POSITION_BITS)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())
    ends = list(itertools.accumulate(row["count"] for row in counts))
    places = {}
    for name, rank in wanted.items():
        if not 1 <= rank <= (ends[-1] if ends else 0):
            raise ValueError(f"rank {rank} is outside the frame")
        i = bisect.bisect_left(ends, rank)
        before = ends[i - 1] if i else 0
        places[(counts[i]["part"] << _POSITION_BITS) + rank - before - 1] = name
    found = placed.where(F.col("_place").isin(list(places))).collect()
    remove(spark, path)
    return {places[row["_place"]]: row for row in found}


def numbered(df: DataFrame, group: str, order: str, into: str = "position") -> DataFrame:
    """``df`` with the 1-based place of every row within its group; ``order`` is unique.

    Range partitions by (group, order), a count per partition and group, and the
    place within the partition: a group of any size spreads over many tasks.
    """
    spark = df.sparkSession
    shared_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, group, order)
        .sortWithinPartitions(group, order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_at", _POSITION_BITS)
    firsts = placed.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        firsts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "group-starts"
    )
    return (
        placed.withColumn("_part", part)
        .join(starts, [group, "_part"])
        .withColumn(into, F.col("_before") + F.col("_at") - F.col("_first") + 1)
        .drop("_part", "_before", "_at", "_first")
    )


def quantile_ranks(n: int, q: float) -> tuple[int, int, float]:
    """Lower rank, upper rank and weight of the linearly interpolated quantile."""
    at = q * (n - 1)
    low = math.floor(at)
    return low + 1, min(low + 2, n), at - low


def quantiles(df: DataFrame, value: str, tie: str, qs: Sequence[float]) -> list[float]:
    """Linearly interpolated quantiles of ``value``; nulls are left out."""
    rows = df.where(F.col(value).isNotNull())
    n = rows.count()
    if n == 0:
        return [math.nan] * len(qs)
    spots = [quantile_ranks(n, q) for q in qs]
    at = order_statistics(rows, [value, tie], [r for low, high, _ in spots for r in (low, high)])
    return [_blend(at[low][value], at[high][value], w) for low, high, w in spots]


def group_quantiles(
    df: DataFrame, group: str, value: str, tie: str, qs: Sequence[float]
) -> dict[object, list[float]]:
    """As :func:`quantiles` within each of a few groups (tiers, segments)."""
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    sizes = sorted((r[group], r["count"]) for r in rows.groupBy(group).count().collect())
    found = {}
    for key, n in sizes:
        spots = [quantile_ranks(n, q) for q in qs]
        own = rows.where(F.col(group) == F.lit(key))
        at = order_statistics(own, [value, tie], [r for low, high, _ in spots for r in (low, high)])
        found[key] = [_blend(at[low][value], at[high][value], w) for low, high, w in spots]
    return found


def _blend(low: float, high: float, weight: float) -> float:
    return float(low) + (float(high) - float(low)) * weight
