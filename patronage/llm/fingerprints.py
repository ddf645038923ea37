"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame operations only.

A text is cut into paragraphs (lines), a long one into runs of
``PARAGRAPH_CHARS`` characters; the sketch holds the set of their 64-bit
digests. Each digest falls into one cell of each of three subtables, and a cell
keeps a count, the XOR of its digests and the XOR of a second hash of them.
Subtracting two sketches cell by cell leaves what the versions don't share.
Peeling takes the cells that hold one digest, removes it from its other cells,
and goes on until nothing is left. How many cells a pair starts with follows
from an estimate of its difference: of the ``STRATUM`` lowest digests of both texts,
how many do they share? Pairs whose cells don't empty are tried
again with four times as many cells, until all are recovered.

Null text counts as empty; two empty texts are equal (likeness 1). Likeness is
the part of distinct paragraph digests that both texts have. Rows of one
``doc_id`` follow one another by a hash of their text; equal rows get equal
results. An empty table gives an empty result. Names that end in ``_fp`` are
the operator's own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import run_folder, shuffles_removed, written

PARAGRAPH_CHARS = 128
BASE_CELLS = 24
SUBTABLES = 3
GROWTH = 4
STRATUM = 16
CELLS_EACH = 2.5
_CHECK_SEED = 77


def digests(text: Column) -> Column:
    """Sorted distinct 64-bit digests of the paragraphs of a text."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^\n]{{1,{PARAGRAPH_CHARS}}}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))))


def _cells(digest: Column, cells: int) -> Column:
    """The cell of a digest in each subtable."""
    each = cells // SUBTABLES
    return F.array(
        *[F.pmod(F.xxhash64(digest, F.lit(cells), F.lit(t)), F.lit(each)) + t * each for t in range(SUBTABLES)]
    )


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(_CHECK_SEED))


def sketches(sets: DataFrame, key: list[str], column: str, cells: int) -> DataFrame:
    """``key, cell, n, digest, hash`` of the filled cells of the digest sets in ``column``."""
    return (
        sets.select(*key, F.explode(column).alias("digest"))
        .select(*key, F.explode(_cells(F.col("digest"), cells)).alias("cell"), "digest")
        .groupBy(*key, "cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("digest").alias("digest"),
            F.bit_xor(_check(F.col("digest"))).alias("hash"),
        )
    )


def _text_of(cells: Column) -> Column:
    """Filled cells as text: cell, count, and both XORs in hexadecimal."""
    return F.array_join(
        F.transform(
            F.array_sort(cells),
            lambda c: F.format_string("%d:%d:%016x:%016x", c["cell"], c["n"], c["digest"], c["hash"]),
        ),
        ",",
    )


def fingerprints(sets: DataFrame, key: str, column: str, cells: int = BASE_CELLS) -> DataFrame:
    """``key, fingerprint``: the sketch of each digest set as text, ahead of it the number of cells."""
    filled = (
        sketches(sets, [key], column, cells)
        .groupBy(key)
        .agg(F.collect_list(F.struct("cell", "n", "digest", "hash")).alias("cells"))
    )
    none = F.from_json(F.lit("[]"), "array<struct<cell:bigint,n:bigint,digest:bigint,hash:bigint>>")
    return sets.select(key).join(filled, key, "left").select(
        key, F.concat(F.lit(f"{cells};"), _text_of(F.coalesce("cells", none))).alias("fingerprint")
    )


def first_try(left: Column, right: Column, cells: int) -> Column:
    """How often ``cells`` have to grow to hold the estimated difference of two sorted digest sets."""
    low, high = F.slice(left, 1, STRATUM), F.slice(right, 1, STRATUM)
    least = F.abs(F.size(left) - F.size(right))
    alike = F.size(F.array_intersect(low, high)) / F.greatest(F.least(F.size(low), F.size(high)), F.lit(1))
    expected = (F.size(left) + F.size(right)) * (1 - alike) / (1 + alike)
    wanted = F.greatest(least, expected) * CELLS_EACH / cells
    return F.greatest(F.ceil(F.log(float(GROWTH), F.greatest(wanted, F.lit(1.0)))), F.lit(0)).cast("int")


def differences(
    pairs: DataFrame, keys: list[str], left: str, right: str, cells: int = BASE_CELLS, listed: bool = True
) -> DataFrame:
    """Recover what two digest sets don't share, per row of ``pairs`` (named by ``keys``).

    Returns ``keys, gone, new``: digests of ``left`` only and of ``right`` only, or
    their numbers if not ``listed``. Pairs without a difference have no row.
    """
    pairs = pairs.select(*keys, left, right, first_try(F.col(left), F.col(right), cells).alias("start_fp"))
    last = pairs.agg(F.max("start_fp")).first()[0] or 0
    found, failed, tried = None, None, 0
    sides = [F.when((F.col("cell") < 0) & (F.col("n") == n), F.col("digest")) for n in (1, -1)]
    put = F.collect_list if listed else F.count
    while tried <= last or failed is not None:
        # Apart, as a union would lose how the rows of ``pairs`` lie.
        todo = [pairs.where(F.col("start_fp") == tried)] if tried <= last else []
        todo += [_again(pairs, failed, keys)] if failed is not None else []
        failed = None
        for part in todo:
            peeled = written(
                _peel(_hopeful(_subtracted(part.drop("start_fp"), keys, left, right, cells), keys), keys, cells)
                .groupBy(*keys)
                .agg(F.max(F.col("cell") >= 0).alias("stuck"), put(sides[0]).alias("gone"), put(sides[1]).alias("new")),
                "sketch-peeled",
            )
            done, stuck = peeled.where("NOT stuck").drop("stuck"), peeled.where("stuck").select(*keys)
            found = done if found is None else found.unionByName(done)
            if not stuck.isEmpty():
                failed = stuck if failed is None else failed.unionByName(stuck)
        cells, tried = cells * GROWTH, tried + 1
    return found


def _again(pairs: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """The failed pairs. The join is on the first key alone, by which ``pairs`` may lie already, so only ``failed`` moves."""
    first, *rest = keys
    if not rest:
        return pairs.join(failed, first, "left_semi")
    again = failed.groupBy(first).agg(F.collect_set(F.struct(*rest)).alias("again_fp"))
    return pairs.join(again, first).where(F.array_contains("again_fp", F.struct(*rest))).drop("again_fp")


def _subtracted(pairs: DataFrame, keys: list[str], left: str, right: str, cells: int) -> DataFrame:
    """Cells of the left sketch minus those of the right one; empty cells are left out."""
    sides = F.array(F.struct(F.lit(1).cast("long").alias("n"), F.col(left).alias("digests")),
                    F.struct(F.lit(-1).cast("long").alias("n"), F.col(right).alias("digests")))
    parts = (
        pairs.select(*keys, F.explode(sides).alias("side"))
        .select(*keys, "side.n", F.explode("side.digests").alias("digest"))
        .select(*keys, "n", "digest", _check(F.col("digest")).alias("hash"), F.explode(_cells(F.col("digest"), cells)).alias("cell"))
    )
    return _summed(parts, keys)


def _pure(cell: Column) -> Column:
    """Whether a subtracted cell holds one digest."""
    return (F.abs(cell["n"]) == 1) & (cell["hash"] == _check(cell["digest"]))


def _hopeful(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells to peel; of a pair without any pure cell, which is stuck at once, one cell to say so."""
    whole = cells.groupBy(*keys).agg(F.collect_list(F.struct("cell", "n", "digest", "hash")).alias("cells"))
    kept = F.when(F.exists("cells", _pure), F.col("cells")).otherwise(F.slice("cells", 1, 1))
    return whole.select(*keys, F.explode(kept).alias("c")).select(*keys, "c.*")


def _summed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Add up the parts of each cell; a cell that has become empty goes."""
    return (
        cells.groupBy(*keys, "cell", F.when(F.col("cell") < 0, F.col("digest")).alias("found"))
        .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("hash").alias("hash"))
        .where("n <> 0 OR digest <> 0 OR hash <> 0")
        .drop("found")
    )


def _peel(cells: DataFrame, keys: list[str], size: int, rounds: int = 9) -> DataFrame:
    """Peel for a number of rounds. Recovered digests stand in rows of cell -1, with their side in ``n``.

    A round looks at one subtable: a digest has one cell there, so it is taken
    once. Rows stay with their pair, so all rounds run in one stage.
    """
    each = size // SUBTABLES
    for i in range(rounds):
        table = i % SUBTABLES
        own = F.struct("cell", "n", "digest", "hash")
        pure = _pure(own) & (F.col("cell") >= table * each) & (F.col("cell") < (table + 1) * each)
        # The digest goes out of all its cells, the pure one among them, and is noted.
        gone = F.transform(
            _cells(F.col("digest"), size),
            lambda c: F.struct(c.alias("cell"), (-F.col("n")).alias("n"), F.col("digest"), F.col("hash")),
        )
        noted = F.struct(F.lit(-1).cast("long").alias("cell"), F.col("n"), F.col("digest"), F.col("hash"))
        parts = F.when(pure, F.concat(F.array(own, noted), gone)).otherwise(F.array(own))
        cells = _summed(cells.select(*keys, F.explode(parts).alias("c")).select(*keys, "c.*"), keys)
    return cells


def next_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key_fp, owner_fp, head_fp``: the document that comes next to each one, in descending ``doc_id``.

    ``key_fp`` names a text that is next to the document ``owner_fp``; the last
    one's next is the first. ``head_fp`` is half of the owner's characters.
    Works on ids and lengths only: range partitions, and the first row of each.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(
        F.col(doc_id).alias("id"), row_key(doc_id, text).alias("key_fp"),
        F.floor(F.coalesce(F.char_length(text), F.lit(0)) / 2).cast("int").alias("head_fp"),
    ).distinct()
    order = [F.col("id").desc_nulls_last(), F.col("key_fp")]
    placed = written(
        ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "fingerprint-order"
    )
    lead = F.lead("key_fp").over(Window.partitionBy("part").orderBy(*order))
    rank = F.struct(F.col("id").isNotNull().alias("some"), F.col("id").alias("id"), F.bitwise_not("key_fp").alias("key"))
    # One row per partition: its first document. The windows over them have no more rows than that.
    firsts = placed.withColumn("rank", rank).groupBy("part").agg(F.max_by("key_fp", "rank").alias("first"))
    along = Window.orderBy("part")
    opens = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(along), F.first("first").over(along)).alias("opens"),
    )
    return (
        placed.withColumn("next", lead)
        .join(opens, "part")
        .select(F.coalesce("next", "opens").alias("key_fp"), F.col("key_fp").alias("owner_fp"), "head_fp")
    )


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table in the shared folder whose rows are known to lie by the hash of ``key``."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"fingerprints_{uuid.uuid4().hex}"
    path = f"{run_folder(spark)}/{name}"
    with shuffles_removed(spark):
        df.write.bucketBy(parts, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(doc_id, text)


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text has its last ``floor(n / 2)`` characters replaced by the
    first as many of the next document. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(row_key(doc_id, text).alias("key_fp"), plain.alias("text_fp"))
    one = texts.groupBy("key_fp").agg(F.first("text_fp").alias("text_fp"))  # equal rows have equal keys
    heads = written(next_documents(docs, doc_id, text), "fingerprint-next")
    following = one.join(heads, "key_fp").select(
        F.col("owner_fp").alias("key_fp"),
        F.expr("left(text_fp, head_fp)").alias("head_fp"),
        digests(F.col("text_fp")).alias("next_fp"),
    )
    n = F.char_length("text_fp")
    edited = F.expr("concat(left(text_fp, char_length(text_fp) - char_length(text_fp) DIV 2), head_fp)")
    # Bucketed by document: sketches, peeling and retries then find a document's digests together.
    sets = bucketed(
        one.join(following, "key_fp")
        .withColumn("edited_fp", edited)
        .select(
            F.col("key_fp").alias("pair"),
            F.char_length("text_fp").cast("long").alias("n_chars"),
            F.sha2(F.col("edited_fp").cast("binary"), 256).alias("edited_sha256"),
            digests(F.col("text_fp")).alias("own"),
            digests(F.col("edited_fp")).alias("edited"),
            F.col("next_fp").alias("next"),
        ),
        "pair",
    )
    # Both comparisons of all documents are peeled together.
    others = F.create_map(F.lit("near_edited"), "edited", F.lit("near_next"), "next")
    compared = sets.select("pair", "own", F.explode(others).alias("with", "other"))
    found = differences(compared, ["pair", "with"], "own", "other", listed=False)
    shared = F.size("own") - F.coalesce("gone", F.lit(0))
    every = F.size("own") + F.coalesce("new", F.lit(0))
    near = F.when(every == 0, F.lit(1.0)).otherwise(shared / every)
    likeness = (
        compared.select("pair", "with", "own").join(found, ["pair", "with"], "left")
        .groupBy("pair")
        .agg(*[F.max(F.when(F.col("with") == c, near)).alias(c) for c in ("near_edited", "near_next")])
    )
    own = fingerprints(sets, "pair", "own")
    changed = fingerprints(sets, "pair", "edited").withColumnRenamed("fingerprint", "edited_fingerprint")
    figures = sets.select("pair", "n_chars", "edited_sha256")
    result = written(figures.join(likeness, "pair").join(own, "pair").join(changed, "pair"), "fingerprint-results")
    ids = docs.select(F.col(doc_id), row_key(doc_id, text).alias("pair"))
    return ids.join(result, "pair").select(
        doc_id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
