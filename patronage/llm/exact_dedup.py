"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when nothing but white space of the set ``[\x20\x09-\x0D]``
tells them apart. The index holds one entry per hash key; its directory starts
with one bucket and doubles for as long as a bucket is overfull. The directory
does not route: of the index only the keys with several rows are used, and the
rows of these meet in a hash aggregate over depth, bucket, key and whole text.
No task owns a key range; comparing whole texts is what tells texts of one key
apart. Partial aggregation keeps one row per distinct text of a task.

Null text counts as empty. Of equal texts the row with the most code points
stays, then the smallest ``doc_id`` (null last), then one of the equal rows.
An empty table gives an empty result. Other columns are passed on if asked for;
names that end in ``_hx`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.session import written

BUCKET_ROWS = 50_000
MAX_DEPTH = 20
_WHITE = " \t\n\x0b\x0c\r"


def stripped(text: Column) -> Column:
    """Text without the white space that does not count."""
    return F.translate(F.coalesce(text, F.lit("")), _WHITE, "")


def _prefix(key: str, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(cell_hx, bucket_hx, depth_hx)``: the bucket of every cell of ``max_depth`` hash bits.

    Doubling goes on while a bucket holds more than ``bucket_rows`` entries; a
    doubling splits the overfull buckets only, the others keep their depth.
    The tables here have at most ``2 ** max_depth`` rows.
    """
    cells = written(
        entries.groupBy(_prefix("key_hx", max_depth).alias("cell_hx")).agg(F.count(F.lit(1)).alias("rows_hx")),
        "hash-cells",
    )
    depth = F.lit(0)  # local depth of the bucket that holds a cell
    for bits in range(max_depth):
        sizes = cells.groupBy(F.shiftright("cell_hx", max_depth - bits).alias("bucket")).agg(
            F.sum("rows_hx").alias("size")
        )
        overfull = sizes.where(F.col("size") > bucket_rows)
        if overfull.isEmpty():
            break
        # Doubled: the halves of an overfull bucket differ in one bit more.
        cells = cells.join(
            overfull.select("bucket", F.lit(bits + 1).alias(f"split{bits}")),
            F.shiftright("cell_hx", max_depth - bits) == F.col("bucket"),
            "left",
        ).drop("bucket")
        depth = F.coalesce(F.col(f"split{bits}"), depth)
    return cells.select("cell_hx", depth.alias("depth_hx")).withColumn(
        "bucket_hx", F.expr(f"shiftright(cell_hx, {max_depth} - depth_hx)")
    )


def build_index(docs: DataFrame, text: str, bits: int, bucket_rows: int, max_depth: int) -> DataFrame:
    """Entries ``(bucket_hx, depth_hx, key_hx, rows_hx)`` sorted by key within bucket files."""
    keys = docs.select(_key(stripped(F.col(text)), bits).alias("key_hx"))
    entries = written(keys.groupBy("key_hx").agg(F.count(F.lit(1)).alias("rows_hx")), "hash-entries")
    buckets = written(directory(entries, bucket_rows, max_depth), "hash-directory")
    placed = entries.withColumn("cell_hx", _prefix("key_hx", max_depth)).join(buckets, "cell_hx").drop("cell_hx")
    return written(
        placed.repartitionByRange("depth_hx", "bucket_hx").sortWithinPartitions("depth_hx", "bucket_hx", "key_hx"),
        "hash-index",
    )


def _key(text: Column, bits: int) -> Column:
    key = F.xxhash64(text)
    # Fewer bits are for tests that need colliding keys.
    return key if bits == 64 else F.shiftleft(key, 64 - bits)


def exact_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: tuple[str, ...] = (),
    bits: int = 64,
    bucket_rows: int = BUCKET_ROWS,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and the columns ``keep``."""
    index = build_index(docs, text, bits, bucket_rows, max_depth)
    shared = index.where("rows_hx > 1").select("bucket_hx", "depth_hx", "key_hx")
    bare = stripped(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_hx"),
        F.struct(*keep).alias("keep_hx") if keep else F.lit(None).cast("int").alias("keep_hx"),
        bare.alias("bare_hx"),
        F.sha2(bare.cast("binary"), 256).alias("sha_hx"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("chars_hx"),
        _key(bare, bits).alias("key_hx"),
    )
    # The text goes on only where its key has more than one row.
    routed = written(
        rows.join(shared, "key_hx", "left")
        .withColumn("bare_hx", F.when(F.col("bucket_hx").isNotNull(), F.col("bare_hx")))
        .withColumn("row_hx", F.monotonically_increasing_id()),
        "hash-routed",
    )
    alone = routed.where("bucket_hx IS NULL").select(
        "doc_hx", "keep_hx", "sha_hx", F.col("doc_hx").alias("id_hx"), F.lit(1).cast("long").alias("size_hx"),
        F.lit(True).alias("kept_hx"),
    )
    # Equal bytes meet in the aggregate, which keeps the texts of one key apart.
    best = F.struct(
        (-F.col("chars_hx")).alias("chars"), F.col("doc_hx").isNull().alias("none"),
        F.col("doc_hx").alias("doc"), F.col("row_hx").alias("row"),
    )
    chain = written(
        routed.where("bucket_hx IS NOT NULL")
        .groupBy("depth_hx", "bucket_hx", "key_hx", "bare_hx")
        .agg(F.min(best).alias("best_hx"), F.count(F.lit(1)).alias("size_hx")),
        "hash-chains",
    )
    grouped = (
        routed.where("bucket_hx IS NOT NULL")
        .join(chain, ["depth_hx", "bucket_hx", "key_hx", "bare_hx"])
        .select(
            "doc_hx", "keep_hx", "sha_hx", F.col("best_hx.doc").alias("id_hx"), "size_hx",
            (F.col("best_hx.row") == F.col("row_hx")).alias("kept_hx"),
        )
    )
    both = alone.unionByName(grouped)
    carried = [F.col(f"keep_hx.{c}").alias(c) for c in keep if c != doc_id]
    return both.select(
        F.col("doc_hx").alias(doc_id), F.col("id_hx").alias("keep_id"), F.col("size_hx").alias("group_size"),
        F.col("kept_hx").alias("kept"), F.col("sha_hx").alias("text_sha256"), *carried,
    )
