"""Quality of documents by hierarchical empirical Bayes over sites.

A classifier reads a document's text and gives the odds that it is of quality.
Sites say more: the rate of a host is a Beta posterior around the global rate,
that of a path a Beta posterior around its host's. How strongly sparse sites
shrink is estimated from the spread of the rates themselves (method of
moments), by grouped aggregation over all documents. A labelled training
document counts with its label, any other with its classifier's probability. A
document's own part is left out of the posteriors that judge it, and

    logit(score) = logit(document) + logit(path) - logit(global).

The classifier is fitted on a bounded sample of about ``SAMPLE_DOCS`` labelled
documents that are not held out, chosen by a hash. Null text counts as empty, a
null host or path as a site named by the empty text. If no label is known, all
evidence is 1/2. A document with several labels has their least one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.textbatch import blocks, hashes, words
from patronage.session import written

SAMPLE_DOCS = 20_000
MOST_STRENGTH = 10_000.0

_KINDS = ("upper", "lower", "digit", "space", "beyond", "mark", "other")
_KIND = np.full(256, 6, np.int64)
for _k, _codes in enumerate([range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), range(128, 256)]):
    _KIND[list(_codes)] = _k
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 5
FEATURES = (*_KINDS, "length", "words", "word_length", "distinct", "lines", "distinct_lines", "few_letters")


@dataclass(frozen=True)
class EvidenceModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # of the features, their squares, and the constant

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = _design((features - self.mean) / self.spread) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def _design(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -6, 6)
    return np.hstack([x, x * x, np.ones((len(x), 1))])


def _ratio(value: np.ndarray, owner: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Distinct values of each row over all of them; 1 where there are none."""
    pair = value ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(pair, return_index=True)
    return np.where(total > 0, np.bincount(owner[first], minlength=len(total)) / np.maximum(total, 1), 1.0)


def text_features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text of a block."""
    rows, size = len(starts) - 1, np.diff(starts)
    of_byte = np.repeat(np.arange(rows), size)
    kinds = np.bincount(of_byte * 7 + _KIND[data], minlength=rows * 7).reshape(rows, 7)
    share = kinds / np.maximum(size, 1)[:, None]
    begin, end, owner = words(data, starts)
    count = np.bincount(owner, minlength=rows)
    length = np.bincount(owner, end - begin, minlength=rows) / np.maximum(count, 1)
    distinct = _ratio(hashes(data, begin, end), owner, count) if len(begin) else np.ones(rows)
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    border[1:] |= np.append(data == 10, False)[:-1]
    line = np.flatnonzero(border[: len(data)])
    line_end = np.append(line[1:], len(data)) if len(line) else line
    line_owner = np.searchsorted(starts, line, side="right") - 1
    lines = np.bincount(line_owner, minlength=rows)
    distinct_lines = _ratio(hashes(data, line, line_end), line_owner, lines) if len(line) else np.ones(rows)
    letters = share[:, 0] + share[:, 1] + share[:, 4]
    return np.column_stack(
        [share, np.log1p(size), np.log1p(count), length, distinct, np.log1p(lines), distinct_lines, letters < 0.7]
    )


def with_features(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns`` and an array ``features`` of every row."""
    rows = docs.select(*columns, text)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in blocks(batch.column(len(columns))):
                made = text_features(data, starts)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), made.shape[1])
                part = batch.select(range(len(columns))).slice(row, len(made))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, flat.cast(pa.list_(pa.float64()))], names=schema.names
                )

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> EvidenceModel:
    """Logistic weights of the text features."""
    given = _labels(labels, doc_id, label)
    size = given.count()
    chosen = given.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < min(1.0, SAMPLE_DOCS / max(1, size)) * 1_000_000)
    # The bound of the sample is the bound of the broadcast and of what is collected.
    sample = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc")
    rows = with_features(sample, ["good"], "text").collect()
    width = len(FEATURES)
    if not rows:
        return EvidenceModel(np.zeros(width), np.ones(width), np.zeros(2 * width + 1))
    x, y = np.array([r.features for r in rows]), np.array([r.good for r in rows], float)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    design = _design((x - mean) / spread)
    ridge = np.diag([1.0] * (2 * width) + [1e-3])
    w = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, design.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    return EvidenceModel(mean, spread, w)


def _labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """``doc, good`` of the labelled documents that are not held out."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    return known.groupBy(F.col(doc_id).alias("doc")).agg((F.min(label) == 1).alias("good"))


def evidence(docs: DataFrame, model: EvidenceModel, columns: list[str], text: str) -> DataFrame:
    """``columns`` and the classifier's probability ``evidence`` of every row."""
    rows = docs.select(*columns, text)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("evidence", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in blocks(batch.column(len(columns))):
                made = model.probability(text_features(data, starts))
                part = batch.select(range(len(columns))).slice(row, len(made))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made)], names=schema.names)

    return rows.mapInArrow(run, schema)


def strength(sites: DataFrame, centre: Column, good: str, n: str) -> Column:
    """Prior observations of a site's rate around ``centre``, by moments over all sites, as one row's figure.

    The spread of the rates beyond what their numbers of documents explain is the
    spread of the Beta prior; the wider it is, the fewer observations it is worth.
    """
    rate = F.col(good) / F.col(n)
    noise = centre * (1 - centre)
    beyond = F.sum(F.col(n) * (rate - centre) ** 2 - noise) / F.sum(n)
    figure = F.sum(noise * F.col(n)) / F.sum(n) / F.greatest(beyond, F.lit(1e-12)) - 1
    row = sites.where(F.col(n) > 0).agg(figure.alias("k")).first()
    return F.lit(float(min(max(row.k if row.k is not None else 1.0, 1.0), MOST_STRENGTH)))


def posteriors(rows: DataFrame, host: str = "host", path: str = "path", part: str = "part") -> tuple[DataFrame, float]:
    """``host, path`` with sums, strengths and posteriors, and the global rate. ``part`` is 0 to 1 per document."""
    paths = written(
        rows.groupBy(host, path).agg(F.sum(part).alias("path_good"), F.count(F.lit(1)).alias("path_n")), "quality-paths"
    )
    hosts = written(
        paths.groupBy(host).agg(F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n")), "quality-hosts"
    )
    sums = hosts.agg(F.sum("host_good").alias("g"), F.sum("host_n").alias("n")).first()
    overall = min(max((sums.g + 0.5) / (sums.n + 1), 1e-6), 1 - 1e-6) if sums.n else 0.5
    k_host = strength(hosts, F.lit(overall), "host_good", "host_n")
    hosts = hosts.withColumns(
        {"host_k": k_host, "host_posterior": (F.col("host_good") + k_host * overall) / (F.col("host_n") + k_host)}
    )
    both = paths.join(hosts, host)
    k_path = strength(both, F.col("host_posterior"), "path_good", "path_n")
    return written(both.withColumn("path_k", k_path), "quality-sites"), overall


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def score(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``doc_id, held_out, host, path, evidence, host_posterior, path_posterior, score, keep`` of every row."""
    model = fit(docs, labels, doc_id, text, label)
    named = docs.select(
        F.col(doc_id).alias("doc"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col(text).alias("text"),
    )
    told = evidence(named, model, ["doc", "host", "path"], "text")
    part = F.coalesce(F.col("good").cast("double"), F.col("evidence"))
    rows = written(
        told.join(_labels(labels, doc_id, label), "doc", "left").withColumn("part", part).drop("good"), "quality-rows"
    )
    sites, overall = posteriors(rows)
    # Without the document's own part.
    h_good, h_n = F.col("host_good") - F.col("part"), F.col("host_n") - 1
    p_good, p_n = F.col("path_good") - F.col("part"), F.col("path_n") - 1
    of_host = (h_good + F.col("host_k") * overall) / (h_n + F.col("host_k"))
    of_path = (p_good + F.col("path_k") * F.col("of_host")) / (p_n + F.col("path_k"))
    z = _logit(F.col("evidence")) + _logit(F.col("of_path")) - _logit(F.lit(overall))
    return (
        rows.join(sites, ["host", "path"])
        .withColumn("of_host", of_host)
        .withColumn("of_path", of_path)
        .withColumn("score", 1 / (1 + F.exp(-z)))
        .select(
            F.col("doc").alias(doc_id), held_out("doc").alias("held_out"), "host", "path", "evidence",
            F.col("of_host").alias("host_posterior"), F.col("of_path").alias("path_posterior"), "score",
            (F.col("score") >= 0.5).alias("keep"),
        )
    )
