"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

Each source is cut into blocks. Source ``s`` of weight ``w`` takes part at the
fluid rate ``w`` until its rows run out; from then on the others share its part
in proportion to their weights. With ``S(v) = sum(min(w v, blocks))`` the fluid
schedule at virtual time ``v``, block ``j`` of a source is released in slot
``floor(S((j - 1) / w))`` and due in slot ``ceil(S(j / w))``. Earliest deadline
first among the released blocks keeps every source less than one block from its
target at every slot.

The slots are scheduled in chunks of ``chunk_slots`` or more. What has run at a
chunk's border is fixed beforehand: of each source, its blocks up to the rounded
down or rounded up fluid part, rounded so that the slots on either side hold all
blocks within their windows. So the chunks are independent rows of bounded length.
Should blocks and slots of a chunk differ in number, the schedule fails.

Null sources are one source. A source without weight gets ``default_weight``.
Weights must be positive. Rows of equal ``doc_id`` follow one another in the
order of a hash of the row's ``order`` columns. No row is dropped or repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import written

BLOCK_ROWS = 16
CHUNK_SLOTS = 128
MOST_SLOTS = 4096
# Doubles near an integer count as that integer, so that windows that meet there do.
ROUNDING = 1e-6


def ranked(docs: DataFrame, source: str, order: list[str]) -> DataFrame:
    """``docs`` with ``n_mx``, the place from 0 of each row within its source.

    Range partitions in the order of (source, order), a count per partition and
    source, and a window within these: no task holds a whole source.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        docs.withColumns({"source_mx": F.coalesce(F.col(source), F.lit("")), "null_mx": F.col(source).isNull()})
        .withColumn("tie_mx", F.xxhash64(*order))
        .repartitionByRange(parts, "source_mx", "null_mx", *order, "tie_mx")
        .sortWithinPartitions("source_mx", "null_mx", *order, "tie_mx")
        .withColumns({"at_mx": F.monotonically_increasing_id(), "part_mx": F.spark_partition_id()}),
        "mix-placed",
    )
    group = ["source_mx", "null_mx"]
    firsts = placed.groupBy("part_mx", *group).agg(F.count(F.lit(1)).alias("size"), F.min("at_mx").alias("first_mx"))
    before = Window.partitionBy(*group).orderBy("part_mx").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.withColumn("start_mx", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    # Rows of a partition stand in order, so a place follows from the first row's place.
    return placed.join(starts, ["part_mx", *group]).withColumn(
        "n_mx", F.col("start_mx") + F.col("at_mx") - F.col("first_mx")
    ).drop("start_mx", "first_mx", "at_mx", "part_mx", "tie_mx")


def _curve(sources: list[tuple[float, int]]) -> tuple[str, str]:
    """SQL templates of S(v) and of its inverse, for the few sources of a mixture."""
    rows = ", ".join(f"named_struct('w', {w!r}D, 'n', {float(n)!r}D)" for w, n in sources)
    fluid = f"aggregate(array({rows}), 0D, (a, s) -> a + least(s.w * ({{v}}), s.n))"
    # S is linear between the virtual times at which sources run out.
    pieces, done, weight = [], 0.0, sum(w for w, _ in sources)
    for w, n in sorted(sources, key=lambda s: s[1] / s[0]):
        end = done + weight * (n / w)
        pieces.append(f"WHEN {{t}} <= {end!r}D THEN ({{t}} - {done!r}D) / {max(weight, w)!r}D")
        done, weight = done + n, weight - w
    last = max(n / w for w, n in sources)
    return fluid, "CASE " + " ".join(pieces) + f" ELSE {last!r}D END"


# Slots before a border that its crossing blocks may take, lowest first. From the border down, each
# slot is free until a block that is released in it and due by the border takes the lowest free one.
_FREE = """
aggregate(
  IF(size(crossing) = 0, slice(sequence(0L, 0L), 1, 0), sequence(border - 1, array_min(crossing.release), -1L)),
  slice(sequence(0L, 0L), 1, 0),
  (free, r) -> slice(
    concat(array(r), free),
    size(filter(due, b -> b.release = r)) + 1,
    size(free) + 1))
"""

# By deadline, each crossing block takes the lowest free slot from its release on, if there is one.
_BEFORE = """
aggregate(
  crossing,
  named_struct('free', free, 'out', slice(crossing, 1, 0)),
  (a, b) -> aggregate(
    slice(filter(a.free, s -> s >= b.release AND size(a.out) < before), 1, 1),
    a,
    (c, pick) -> named_struct('free', array_remove(c.free, pick), 'out', concat(c.out, array(b)))),
  a -> a.out)
"""

# Step i of a chunk takes the first waiting block, by deadline, whose release slot has come.
_FOLD = """
aggregate(
  sequence(0, size(waiting) - 1),
  named_struct('waiting', waiting, 'out', slice(waiting, 1, 0)),
  (a, i) -> aggregate(
    slice(filter(a.waiting, b -> b.release <= chunk * {slots} + i), 1, 1),
    a,
    (c, pick) -> named_struct(
      'waiting', filter(c.waiting, b -> NOT (b = pick)),
      'out', concat(c.out, array(pick)))),
  a -> IF(
    size(waiting) = least({slots}, {blocks} - chunk * {slots}) AND size(a.out) = size(waiting),
    a.out,
    raise_error(concat('slots and blocks of chunk ', chunk, ' differ in number'))))
"""


def schedule(sources: DataFrame, chunk_slots: int = CHUNK_SLOTS) -> DataFrame:
    """Slots of all blocks, for one row ``source_mx, null_mx, weight, blocks`` per source.

    Returns ``source_mx, null_mx, block, release, deadline, slot``.
    """
    listed = [(float(r.weight), int(r.blocks)) for r in sources.select("weight", "blocks").collect()]
    if any(not w > 0 for w, _ in listed):
        raise ValueError("weights must be positive")
    if not listed:
        return sources.selectExpr(
            "source_mx", "null_mx", "0L AS block", "0L AS release", "0L AS deadline", "0L AS slot"
        ).limit(0)
    # A window is at most this long; a chunk is longer, so a block meets one border at most.
    longest = math.ceil(sum(w for w, _ in listed) / min(w for w, _ in listed)) + 2
    if longest > MOST_SLOTS:
        raise ValueError(f"a weight is below 1/{MOST_SLOTS} of all weights")
    slots = max(chunk_slots, longest)
    fluid, inverse = _curve(listed)
    blocks = (
        sources.withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks"))))
        .withColumn("release", F.expr(f"CAST(floor({fluid.format(v='(block - 1) / weight')} + {ROUNDING}) AS BIGINT)"))
        .withColumn("deadline", F.expr(f"CAST(ceil({fluid.format(v='block / weight')} - {ROUNDING}) AS BIGINT)"))
        .withColumn("chunk", F.floor(F.col("release") / slots))
        .withColumn("border", (F.col("chunk") + 1) * slots)
        .withColumn("part", F.when(
            F.col("deadline") > F.col("border"), F.expr(f"weight * ({inverse.format(t='border')}) - (block - 1)")
        ).otherwise(0.0))
    )
    # At a border the fluid schedule is inside one block of some sources. As many of these blocks as
    # their done parts add up to come before the border: the earliest deadlines first, but from each
    # slot on no more of them than the blocks due there leave slots. Among the choices that the slots
    # before the border can hold, this one leaves the fewest blocks of each deadline for those after
    # it, and as the fluid schedule can be rounded to one that keeps all windows, few enough.
    columns = ["deadline", "source_mx", "null_mx", "block", "release"]
    held = (
        blocks.groupBy("chunk", "border")
        .agg(
            F.collect_list(F.when(F.col("deadline") <= F.col("border"), F.struct(*columns))).alias("due"),
            F.sort_array(
                F.collect_list(F.when(F.col("deadline") > F.col("border"), F.struct(*columns)))
            ).alias("crossing"),
            F.round(F.sum("part")).alias("before"),
        )
        .withColumn("free", F.expr(_FREE))
        .withColumn("early", F.expr(_BEFORE))
    )
    placed = held.select("chunk", F.inline(F.concat("due", "early"))).unionByName(
        held.select((F.col("chunk") + 1).alias("chunk"), F.inline(F.array_except("crossing", "early")))
    )
    chunks = placed.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("waiting"))
    fold = _FOLD.format(slots=slots, blocks=sum(n for _, n in listed))
    return chunks.select("chunk", F.posexplode(F.expr(fold)).alias("at", "b")).select(
        "b.source_mx", "b.null_mx", "b.block", "b.release", "b.deadline",
        (F.col("chunk") * slots + F.col("at")).alias("slot"),
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float],
    default_weight: float = 1.0,
    source: str = "source",
    order: tuple[str, ...] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
    chunk_slots: int = CHUNK_SLOTS,
) -> DataFrame:
    """``docs`` with ``block``, ``release``, ``deadline``, ``slot`` and ``in_block`` of each row.

    Sorting by ``slot, in_block`` gives the mixture. Names that end in ``_mx``
    are the operator's own; columns with the names of results are replaced.
    """
    kept = docs.drop("block", "release", "deadline", "slot", "in_block")
    rows = ranked(kept, source, list(order))
    size = F.ceil(F.count(F.lit(1)) / block_rows)
    given = F.lit(float(default_weight))
    for name, weight in weights.items():
        given = F.when((F.col("source_mx") == name) & ~F.col("null_mx"), F.lit(float(weight))).otherwise(given)
    sources = written(
        rows.groupBy("source_mx", "null_mx").agg(size.alias("blocks")).withColumn("weight", given), "mix-sources"
    )
    slots = written(schedule(sources, chunk_slots), "mix-slots")
    return (
        rows.withColumns(
            {"block": F.floor(F.col("n_mx") / block_rows) + 1, "in_block": (F.col("n_mx") % block_rows).cast("int")}
        )
        .join(slots, ["source_mx", "null_mx", "block"])
        .drop("source_mx", "null_mx", "n_mx")
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of a mixture laid out in its order over range partitions."""
    return mixed.repartitionByRange("slot", "in_block").sortWithinPartitions("slot", "in_block")


def placed_rows(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """The whole rows of ``docs`` with ``slot`` and ``in_block`` of their mixture, in no order.

    Slots are worked out on ids and sources alone; the rows go to them in one
    join. Equal rows take the slots of one another.
    """
    source, order = options.get("source", "source"), list(options.get("order", ("doc_id",)))
    kept = docs.drop("slot", "in_block")
    # A hash passes over nulls, so which columns are null is hashed as well.
    values = [*map(F.col, kept.columns), *(F.col(c).isNull() for c in kept.columns)]
    keys = {"key_mr": F.xxhash64(*values), "key2_mr": F.xxhash64(F.lit(1), *values)}
    narrow = kept.select(*dict.fromkeys([source, *order]), *(key.alias(name) for name, key in keys.items()))
    mixed = written(mix(narrow, weights, **options).select(*keys, "slot", "in_block"), "mix-rows")
    places = mixed.groupBy(*keys).agg(F.collect_list(F.struct("slot", "in_block")).alias("places_mr"))
    found = kept.withColumns(keys).join(places.hint("shuffle_hash"), list(keys))
    once = found.where(F.size("places_mr") == 1)
    equal = found.where(F.size("places_mr") > 1).dropDuplicates(list(keys))
    return (
        once.select(*kept.columns, F.col("places_mr")[0]["slot"].alias("slot"), F.col("places_mr")[0]["in_block"].alias("in_block"))
        .unionByName(equal.select(*kept.columns, F.inline("places_mr")))
    )


def mixed_rows(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """As :func:`placed_rows`, laid out in the order of the mixture in one range exchange."""
    return in_order(placed_rows(docs, weights, **options))
