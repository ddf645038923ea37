"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import (
    centroids, exact_dedup, fingerprints, language, lattice_lm, mixing, near_join, quality, sentencepieces, substrings,
    toxicity, turn_tries, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"

# The mixture: twice the weight of an ordinary source for the two largest crawls, half for the smallest.
TARGET_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0, "src19": 0.5}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.write_and_read(table(spark, folder, "pages")).drop("url")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict(table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predict(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_lm.score(table(spark, folder, "documents"), PIECE_MODEL)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents name no address: their source is the host, and a path of it is one of its languages."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.score(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return mixing.mix(docs, TARGET_WEIGHTS)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.round_trip(table(spark, folder, "documents"), PIECE_MODEL)


def op9_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.components(table(spark, folder, "documents"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, folder, "documents"))


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.report(table(spark, folder, "embeddings"))


def op12_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).drop("removed")


def op13_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_tries.trie(table(spark, folder, "conversations")).nodes.drop("code")


def queries() -> dict[str, Query]:
    return {
        "op1_warc": op1_warc,
        "op2_language": op2_language,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_lattice_lm": op5_lattice_lm,
        "op6_quality": op6_quality,
        "op7_mixing": op7_mixing,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_near_join": op9_near_join,
        "op10_fingerprints": op10_fingerprints,
        "op11_centroids": op11_centroids,
        "op12_substrings": op12_substrings,
        "op13_turn_trie": op13_turn_trie,
    }
