"""Likelihood of texts under all segmentations into the pieces of an existing vocabulary.

A text is its words, each with the whitespace marker ahead, and one end. The
pieces' log scores come from the vocabulary file; ``ROUNDS`` times they are
weighed anew by the expected number of uses of each piece over all segmentations
of the distinct training words (forward and backward recursion in log space),
with ``PRIOR_USES`` uses spread by the vocabulary's scores. The pieces stay as
they are. A word's lattice has one more arc if training has seen the word: over
the whole of it, weighted by its count less ``DISCOUNT``; what the discounts free
is the weight of the paths over pieces. A text's score is the log10 of its
probability summed over all segmentations.

Byte pieces are part of every lattice, so every text has a probability. Words
are counted over all documents, scored once each, and joined back to the
documents by a 64-bit hash. The few words that make up 1/``HOT_SHARE`` of all
tokens each, at most ``HOT_SHARE`` of them, are broadcast instead, so no join
partition holds a hot word. Null text counts as empty: one end. Rows that
repeat ``doc_id`` and text share their figures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.pieces import Lattice, PieceTable, load_pieces
from patronage.llm.textbatch import LOWER, blocks, bytes_of, hashes, strings, words
from patronage.session import written

PRIOR_USES = 1000.0
HOT_SHARE = 2000
SMOOTHING = 0.1
ROUNDS = 2
DISCOUNT = 0.75
_LEAST_BYTE = -16.0  # log of the prior part of all byte pieces together


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def prior(table: PieceTable) -> np.ndarray:
    """Probabilities of the pieces from the vocabulary's scores; byte pieces share a small part."""
    share = np.zeros(len(table.scores))
    plain = table.piece_at[table.piece_at >= 0]
    share[plain] = np.exp(table.scores[plain] - table.scores[plain].max())
    least = np.exp(_LEAST_BYTE)
    share *= (1 - least) / share.sum()
    share[table.byte_ids] += least / 256
    return share


def forward(table: PieceTable, logs: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Log of the probability of every beginning of every span, in the lattice's cells."""
    alpha = np.full(lattice.cells, -np.inf)
    alpha[lattice.slot] = 0.0
    byte_logs = logs[table.byte_ids]
    for i, reach in enumerate(lattice.reach):
        rows = np.arange(reach)
        here = alpha[lattice.slot[:reach] + i]
        to = lattice.slot[:reach] + i + 1
        alpha[to] = np.logaddexp(alpha[to], here + byte_logs[lattice.data[lattice.start[:reach] + i]])
        for hit, piece, depth in lattice.walk(table, rows, i):
            to = lattice.slot[hit] + i + depth
            alpha[to] = np.logaddexp(alpha[to], here[hit] + logs[piece])
    return alpha


def expected_uses(table: PieceTable, logs: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Expected uses of every piece over all segmentations of the spans."""
    alpha = forward(table, logs, lattice)
    last = lattice.slot + lattice.length
    beta = np.full(lattice.cells, -np.inf)
    beta[last] = 0.0
    uses = np.zeros(len(logs))
    whole = alpha[last]
    for i in range(len(lattice.reach) - 1, -1, -1):
        reach = lattice.reach[i]
        rows = np.arange(reach)
        at = lattice.slot[:reach] + i
        lead = alpha[at] - whole[:reach]
        byte = table.byte_ids[lattice.data[lattice.start[:reach] + i]]
        rest = beta[at + 1] + logs[byte]
        uses += np.bincount(byte, np.exp(lead + rest), minlength=len(logs))
        total = rest
        for hit, piece, depth in lattice.walk(table, rows, i):
            rest = beta[lattice.slot[hit] + i + depth] + logs[piece]
            uses += np.bincount(piece, np.exp(lead[hit] + rest), minlength=len(logs))
            total[hit] = np.logaddexp(total[hit], rest)
        beta[at] = total
    return uses


def _marked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a column with the marker ahead of each: bytes, begins, ends."""
    data, starts = bytes_of(column)
    lengths = np.diff(starts)
    begin = starts[:-1] + np.arange(len(lengths))
    out = np.full(len(data) + len(lengths), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[begin] = False
    out[inside] = data
    return out, begin, begin + 1 + lengths


def _slices(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    for row, _, starts in blocks(batch.column(place), 1 << 20):
        yield batch.slice(row, len(starts) - 1)


def tokens(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``key, word_key, n`` of every distinct word of every row."""
    rows = docs.select(F.xxhash64(doc_id, text).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in blocks(batch.column(1)):
                begin, end, owner = words(data := LOWER[data], starts)
                if not len(begin):
                    continue
                value = hashes(data, begin, end)
                order = np.lexsort((value, owner))
                value, owner = value[order], owner[order]
                new = np.ones(len(value), bool)
                new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(value)))
                key = batch.column(0).to_numpy()[row + owner[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(value[at].view(np.int64)), pa.array(n, pa.int32())],
                    names=["key", "word_key", "n"],
                )

    return rows.mapInArrow(run, "key long, word_key long, n int")


def vocabulary(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``word_key, word, c`` of every distinct word of all rows; ``c`` counts it in the training rows."""
    rows = docs.select((~held_out(doc_id)).alias("train"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, starts in blocks(batch.column(1), 4 << 20):
                begin, end, owner = words(data := LOWER[data], starts)
                if not len(begin):
                    continue
                value, first, inverse = np.unique(hashes(data, begin, end), return_index=True, return_inverse=True)
                n = np.bincount(inverse, train[row + owner].astype(float)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), strings(data, begin[first], end[first]), pa.array(n)],
                    names=["word_key", "word", "c"],
                )

    found = rows.mapInArrow(run, "word_key long, word string, c long")
    return found.groupBy("word_key", "word").agg(F.sum("c").alias("c"))


def fit(vocab: DataFrame, table: Broadcast) -> np.ndarray:
    """Log probabilities of the pieces from the distinct training words."""
    start = prior(table.value)
    logs = np.log(np.maximum(start, 1e-300))
    for _ in range(ROUNDS):
        rows = _uses(vocab, table, logs).groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # one per piece
        uses = PRIOR_USES * start
        for row in rows:
            uses[row.piece] += row.uses
        logs = np.log(np.maximum(uses, 1e-300) / uses.sum())
    return logs


def _uses(vocab: DataFrame, table: Broadcast, logs: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(len(logs))
        for batch in batches:
            for part in _slices(batch, 0):
                uses += expected_uses(table.value, logs, Lattice(*_marked(part.column(0))))
        at = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(uses[at])], names=["piece", "uses"])

    return vocab.where("c > 0").select("word").mapInArrow(run, "piece long, uses double")


def scored_words(vocab: DataFrame, table: Broadcast, logs: np.ndarray, tokens: int, kinds: int) -> DataFrame:
    """``word_key, c, lattice``: the log10 probability of each word over all its segmentations."""
    freed = DISCOUNT * kinds / tokens if tokens else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                lattice = Lattice(*_marked(part.column(1)))
                alpha = forward(table.value, logs, lattice)
                pieces = np.empty(part.num_rows)
                pieces[lattice.order] = alpha[lattice.slot + lattice.length]
                whole = np.maximum(part.column(2).to_numpy() - DISCOUNT, 0) / max(tokens, 1)
                with np.errstate(divide="ignore"):
                    value = np.logaddexp(np.log(whole), np.log(freed) + pieces) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(value)], names=["word_key", "c", "lattice"]
                )

    return vocab.select("word_key", "word", "c").mapInArrow(run, "word_key long, c long, lattice double")


def score(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    table = docs.sparkSession.sparkContext.broadcast(load_pieces(model_file))
    vocab = written(vocabulary(docs, doc_id, text), "lattice-words")
    ends = docs.where(~held_out(doc_id)).count()
    sums = vocab.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    train_tokens = (sums.n or 0) + ends
    distinct = (sums.v or 0) + (1 if ends else 0)
    found = written(scored_words(vocab, table, fit(vocab, table), train_tokens, distinct), "lattice-scores")
    end_log = math.log10((ends - DISCOUNT) / train_tokens) if ends else math.log10(0.5)

    def base(c: Column) -> Column:
        return F.log10((c + SMOOTHING) / F.lit(train_tokens + SMOOTHING * (distinct + 1)))

    # At most HOT_SHARE words can have that share of the counts.
    hot = found.where((F.col("c") > 0) & (F.col("c") * HOT_SHARE >= train_tokens)).select(
        "word_key", F.col("c").alias("hot_c"), F.col("lattice").alias("hot_lattice")
    )
    uses = tokens(docs, doc_id, text).join(F.broadcast(hot), "word_key", "left")
    columns = ["key", "n", "c", "lattice"]
    common = uses.where("hot_c IS NOT NULL").select("key", "n", F.col("hot_c").alias("c"), F.col("hot_lattice").alias("lattice"))
    rare = uses.where("hot_c IS NULL").select("key", "n", "word_key").join(found, "word_key").select(*columns)
    n = F.col("n")

    def summed(part: DataFrame) -> DataFrame:
        return part.groupBy("key").agg(
            F.sum(n).alias("words"), F.sum(F.when(F.col("c") > 0, n).otherwise(0)).alias("known"),
            F.sum(n * base(F.col("c"))).alias("base"), F.sum(n * F.col("lattice")).alias("lattice"),
        )

    parts = summed(common).unionByName(summed(rare))
    total = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("words", "known", "base", "lattice")])
    rows = docs.select(doc_id, held_out(doc_id).alias("held_out"), F.xxhash64(doc_id, text).alias("key"))
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    none = F.lit(0)
    each = F.coalesce("rows", F.lit(1))
    end_known = 1 if ends else 0
    return (
        rows.join(total, "key", "left").join(same, "key", "left")
        .select(
            doc_id, "held_out",
            (F.coalesce(F.col("words") / each, none) + 1).cast("long").alias("n_tokens"),
            (F.coalesce(F.col("known") / each, none) + end_known).cast("long").alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (F.coalesce(F.col("base") / each, F.lit(0.0)) + base(F.lit(ends))).alias("base_score"),
            (F.coalesce(F.col("lattice") / each, F.lit(0.0)) + F.lit(end_log)).alias("score"),
        )
    )
