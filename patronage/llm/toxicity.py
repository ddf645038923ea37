"""Toxicity by compression distance under two zstandard dictionaries.

One dictionary is trained on toxic text, one on ordinary text. Text is read in
windows of one word; a window stands between fixed carrier bytes that both
dictionaries end with, since the compressor looks for no match within the last
bytes of its input. The gain of a window is its compressed length under the
ordinary dictionary minus that under the toxic one. Thresholds on the gain and
on the number of windows above it are calibrated on the training documents.

What toxic and ordinary text share would fill both dictionaries alike, so the
toxic samples are the words of toxic documents with a part that is ten times as
frequent there, and the ordinary dictionary is extended by ordinary words that
the first pair of dictionaries took for toxic ones (``ROUNDS`` times).

Learning uses a bounded sample of labelled documents: about ``TOXIC_DOCS`` and
``ORDINARY_DOCS``, chosen by a hash of ``doc_id``. Without a toxic label every
score is 0. Null and empty texts have no windows and get the score of such a
text. A document with several labels is toxic if one of them says so.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.textbatch import blocks, hashes, strings, words
from patronage.session import written

TOXIC_DOCS = 3000
ORDINARY_DOCS = 6000
SAMPLE_WORDS = 30_000
TOXIC_BYTES = 4096
ORDINARY_BYTES = 65_536
ROUNDS = 2
HARD_GAIN = 3
LEVEL = 9
GAINS = (2, 3, 4, 5, 6)
_PARTS = (4, 5, 6, 8)  # lengths of word beginnings that are compared besides whole words

# Carrier bytes around a window: controls that text does not use.
_BEFORE = bytes([31, 7, 28, 2, 30, 5, 14, 19, 1, 2, 3, 4, 5, 6, 7, 8])
_AFTER = bytes(range(14, 32))

# Bytes of words; letters beyond ASCII are in the upper half.
_WORD = np.full(256, 0x20, np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _WORD[_c] = _c


@dataclass(frozen=True)
class ToxicityModel:
    """Both dictionaries and the calibration; bounded by the sizes above."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # of log(1 + windows with a gain of GAINS[i] or more), then the constant

    def score(self, counts: np.ndarray) -> np.ndarray:
        z = np.log1p(counts) @ np.array(self.weights[:-1]) + self.weights[-1]
        # A constant of -500 stands for a model without a toxic label.
        return np.where(z <= -500, 0.0, 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


class Gains:
    """Compressed-length gains of words, kept for words seen before in the task."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary, self.known = _compressor(toxic), _compressor(ordinary), {}

    def of(self, word: bytes) -> int:
        gain = self.known.get(word)
        if gain is None:
            if len(self.known) > 500_000:
                self.known.clear()
            window = b"%b %b %b" % (_BEFORE, word, _AFTER)
            gain = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
            self.known[word] = gain
        return gain


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    content = content + _BEFORE + _AFTER
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=64, min_match=3, write_content_size=False,
        write_dict_id=False, write_checksum=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


def _trained(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=24, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: they are the dictionary
        return b"".join(sorted(set(samples)))[-size:]


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, rows, bytes, begin, end, owner)`` of the lower-case words of blocks of rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for row, data, starts in blocks(pc.utf8_lower(column.fill_null(""))):
        data = _WORD[data]
        yield row, len(starts) - 1, data, *words(data, starts)


def word_counts(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns, word, n`` of every distinct word of every row."""
    rows = docs.select(*columns, text)
    schema = rows.select(*columns, F.lit("").alias("word"), F.lit(0).cast("long").alias("n")).schema
    place = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, begin, end, owner in tokens(batch.column(place)):
                pair = hashes(data, begin, end) ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, first, n = np.unique(pair, return_index=True, return_counts=True)
                kept = batch.select(range(place)).take(pa.array(owner[first] + row))
                made = [strings(data, begin[first], end[first]), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=schema.names)

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``doc, toxic, text`` of a bounded sample of the labelled documents that are not held out."""
    given = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("doc"))
        .agg((F.max(label) == 1).alias("toxic"))
        .where(~held_out("doc"))
    )
    sizes = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    part = F.when(F.col("toxic"), min(1.0, TOXIC_DOCS / max(1, sizes.get(True, 0)))).otherwise(
        min(1.0, ORDINARY_DOCS / max(1, sizes.get(False, 0)))
    )
    chosen = given.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < part * 1_000_000)
    # The bound of the sample is the bound of the broadcast.
    sample = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc")
    # Copies of one text would count as many.
    return sample.groupBy(F.xxhash64("text").alias("key"), "toxic").agg(
        F.first("text").alias("text"), F.min("doc").alias("doc")
    )


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Train both dictionaries and calibrate the thresholds."""
    sample = written(training_sample(docs, labels, doc_id, text, label), "toxicity-sample")
    counted = written(word_counts(sample, ["doc", "toxic"], "text"), "toxicity-words")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_ordinary = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic:
        return ToxicityModel(b"", b"", (*[0.0] * len(GAINS), -500.0))
    whole = F.array("word", *[F.when(F.char_length("word") > k, F.expr(f"left(word, {k})")) for k in _PARTS])
    parts = counted.select("doc", "toxic", "word", "n", F.explode(F.array_compact(whole)).alias("part"))
    hits = F.count_distinct(F.when(F.col("toxic"), F.col("doc")))
    rest = F.count_distinct(F.when(~F.col("toxic"), F.col("doc")))
    telling = (
        parts.groupBy("part").agg(hits.alias("hits"), rest.alias("rest"))
        .where(F.col("hits") >= max(3, 0.01 * n_toxic))
        .where(F.col("hits") / n_toxic > 10 * (F.col("rest") + 0.3) / max(1, n_ordinary))
    )
    samples = (
        parts.where("toxic").join(telling, "part").select("doc", "word", "n").distinct()
        .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS).collect()
    )
    usual = written(counted.where("NOT toxic").groupBy("word").agg(F.sum("n").alias("n")), "toxicity-usual")
    common = usual.orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS).collect()
    toxic = _trained(_in_turn(samples, 500), TOXIC_BYTES)
    base = _trained(_in_turn(common, 8), ORDINARY_BYTES)
    ordinary, hard = base, set()
    for _ in range(ROUNDS):
        taken = _mistaken(usual, toxic, ordinary).orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS)
        more = {r.word for r in taken.collect()} - hard
        if not more:
            break
        hard |= more
        ordinary = " ".join(sorted(hard)).encode() + base
    return ToxicityModel(toxic, ordinary, _calibrated(sample, toxic, ordinary))


def _in_turn(counted: list, most: int) -> list[bytes]:
    """Each word as often as it was counted, ``most`` times at most, in a mixed order.

    The trainer takes the best segment of each stretch of its samples, so the
    copies of a word must not stand together.
    """
    drawn = [(zlib.crc32(f"{r.word} {i}".encode()), r.word) for r in counted for i in range(min(r.n, most))]
    return [f" {word} ".encode() for _, word in sorted(drawn)]


def _mistaken(usual: DataFrame, toxic: bytes, ordinary: bytes) -> DataFrame:
    """Ordinary words that gain from the toxic dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(toxic, ordinary)
        for batch in batches:
            yield batch.filter(pa.array([gains.of(w.encode()) >= HARD_GAIN for w in batch.column(0).to_pylist()]))

    return usual.select("word", "n").mapInArrow(run, "word string, n long")


def window_counts(gains: Gains, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, counts)``: for blocks of rows, the windows with a gain of each of ``GAINS`` or more."""
    for row, rows, data, begin, end, owner in tokens(column):
        _, first, inverse = np.unique(hashes(data, begin, end), return_index=True, return_inverse=True)
        flat = data.tobytes()
        spans = zip(begin[first].tolist(), end[first].tolist())
        gain = np.array([gains.of(flat[a:b]) for a, b in spans] or [0])[inverse if len(inverse) else []]
        counts = np.zeros((rows, len(GAINS)))
        for k, least in enumerate(GAINS):
            counts[:, k] = np.bincount(owner[gain >= least], minlength=rows)
        yield row, counts


def _calibrated(sample: DataFrame, toxic: bytes, ordinary: bytes) -> tuple[float, ...]:
    """Logistic weights over the window counts; 0.5 is where the balanced accuracy is best."""
    schema = "toxic boolean, counts array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(toxic, ordinary)
        for batch in batches:
            for row, counts in window_counts(gains, batch.column(1)):
                label = batch.column(0).slice(row, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [label, pa.array(list(counts), pa.list_(pa.float64()))], names=["toxic", "counts"]
                )

    rows = sample.select("toxic", "text").mapInArrow(run, schema).collect()
    y = np.array([r.toxic for r in rows], float)
    x = np.hstack([np.log1p(np.array([r.counts for r in rows])), np.ones((len(y), 1))])
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    ridge = np.diag([1.0] * len(GAINS) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (share * p * (1 - p))) @ x + ridge, x.T @ (share * (y - p)) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    z = x @ w
    at = np.unique(z)
    cuts = np.concatenate([[at[0] - 1], (at[1:] + at[:-1]) / 2, [at[-1] + 1]])
    high = np.sort(z[y == 1])
    low = np.sort(z[y == 0])
    right = 1 - np.searchsorted(high, cuts) / max(1, len(high)) + np.searchsorted(low, cuts) / max(1, len(low))
    best = cuts[right >= right.max() - 1e-12]
    w[-1] -= float(best[len(best) // 2])
    return tuple(w.tolist())


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the toxicity of ``text`` from 0 to 1; a column named like the result is replaced."""
    kept = docs.drop(into)
    schema = kept.withColumn(into, F.lit(0.0)).schema
    place = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model.toxic, model.ordinary)
        for batch in batches:
            for row, counts in window_counts(gains, batch.column(place)):
                part = batch.slice(row, len(counts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(counts))], names=schema.names)

    return kept.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
