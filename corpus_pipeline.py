"""A corpus pipeline of five stages, each over all rows that the one before it kept.

Toxic documents go; of exact copies and of near copies one stays; the rest is
put in the order of the target mixture and encoded to piece ids. Sorting the
result by ``slot, in_block`` gives the mixture. ``STAGES`` lists the stages, ``run`` applies them to ``documents``. Each stage's rows are
written as Parquet and read back, which also cuts the lineage.

Null and empty texts are not toxic, equal one another, have no near copies and no
pieces (null: null). Rows that repeat are copies. No row gives no row. Other columns are
carried along, whatever their names.

``ORACLE_SQL`` is None: compression lengths can't be had in SQL. The tests hold
exact dedup and the order and weights of the mixture against a plain version;
of the other stages they compare row counts and ids here, and test the
operators on their own.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import exact_dedup, mixing, near_join, sentencepieces, toxicity
from patronage.llm.registry import PIECE_MODEL, TARGET_WEIGHTS, table
from patronage.session import noted, remove, written

ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Intermediate tables of earlier stages, removed once the rows made from them are written and
# reread; each thread has its own.
_left: ContextVar[tuple[str, ...]] = ContextVar("left", default=())


def tidy(stage: Stage) -> Stage:
    """Remove what earlier stages have left in the shared folder, unless ``docs`` still reads it, then run the stage."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read, kept = docs.inputFiles(), []
        for path in _left.get():
            name = path.rsplit("/", 1)[1]
            if any(f"/{name}/" in file for file in read):
                kept.append(path)
            else:
                remove(spark, path)
        with noted() as paths:
            result = stage(spark, docs, sf_dir)
        _left.set((*kept, *paths))
        return result

    return run_stage


def shielded(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with columns other than ``needed`` under names that no operator has."""
    return docs.select(*[F.col(f"`{c}`").alias(new) for c, new in _shields(docs, needed).items()])


def restored(df: DataFrame, docs: DataFrame, *needed: str) -> list[Column]:
    """The columns of ``docs`` out of ``df``, which came of the shielded rows."""
    return [df[new].alias(c) for c, new in _shields(docs, needed).items()]


def _shields(docs: DataFrame, needed: tuple[str, ...]) -> dict[str, str]:
    return {c: c if c in needed else f"c{i}_cp" for i, c in enumerate(docs.columns)}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below 0.5."""
    rows = shielded(docs, "doc_id", "text")
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"))
    scored = toxicity.score(rows, model).where("score < 0.5")
    return scored.select(*restored(scored, docs, "doc_id", "text"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row that exact dedup keeps."""
    rows = shielded(docs, "doc_id", "text")
    found = exact_dedup.exact_duplicates(rows, keep=tuple(c for c in rows.columns if c != "doc_id")).where("kept")
    return found.select(*restored(found, docs, "doc_id", "text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of links the row of the smallest ``doc_id`` stays; one row of it, should it repeat.

    Rows without an id or without words are in no group and stay.
    """
    found = near_join.one_of_each(shielded(docs, "doc_id", "text"))
    return found.select(*restored(found, docs, "doc_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, laid out in the order of the mixture."""
    found = mixing.mixed_rows(shielded(docs, "doc_id", "source"), TARGET_WEIGHTS)
    return found.select(*restored(found, docs, "doc_id", "source"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their piece ids and their place in the mixture, as files keep no order across reads.

    ``slot`` and ``in_block`` are worked out again: they follow from the ids and sources of the rows. Of the
    columns added, one whose name the rows have already gets ``_`` behind it.
    """
    needed = ("doc_id", "text", "source")
    placed = mixing.placed_rows(shielded(docs, *needed), TARGET_WEIGHTS)
    encoded = sentencepieces.encode(placed, PIECE_MODEL).withColumn("n_pieces", F.size("piece_ids"))
    taken, added = {c.lower() for c in docs.columns}, []
    for name in ("slot", "in_block", "piece_ids", "n_pieces"):
        free = name
        while free in taken:
            free += "_"
        taken.add(free)
        added.append(encoded[name].alias(free))
    return encoded.select(*restored(encoded, docs, *needed), *added)


STAGES = [
    ("toxicity", tidy(drop_toxic)),
    ("exact_dedup", tidy(drop_exact_copies)),
    ("ngram_jaccard_join", tidy(drop_near_copies)),
    ("mixing", tidy(mix_sources)),
    ("sentencepiece", tidy(encode_pieces)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
