"""Removal of repeated passages, found by anchors at the positions of a difference cover.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window
over it has the word sequence of a window that starts earlier: in a document
before it, or earlier in the same one.

Only the positions whose remainder modulo ``PERIOD`` is in ``COVER`` are hashed, by
spans of ``ANCHOR`` words. Every difference modulo ``PERIOD`` is one of two members
of ``COVER``, so two equal windows have, at one and the same offset below
``PERIOD``, an anchor each, and these are equal, as ``ANCHOR + PERIOD - 1 = WINDOW``.

1. Hashes that occur once leave: a count per hash fills a bitmap of fixed size.
2. Of every other hash the earliest occurrence is found. Anchors of a document
   that point to one document at one distance and touch each other extend to a
   run; a run of ``WINDOW`` words or more is a repeated passage, without pairs.
3. What remains are windows over an anchor that has an earlier occurrence, but
   in no run: at the ends of passages, and where the earliest occurrence goes on
   otherwise than a later one. Their 128-bit names meet those of all windows over
   repeated anchors in an aggregate, and the earliest wins.

Documents of one word sequence are one class (128-bit name) and only the first
goes through all that; the others, with ``WINDOW`` words or more, are repeated whole.

The order is that of ``doc_id``, null last. Rows that repeat an id are documents of
their own, in the order of their words' names; of rows equal in both one is first.
Null text has no words. A document is held whole in its task, and no list but
that of one document's anchors is ever collected. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.bitmaps import bitmap, held
from patronage.llm.textbatch import blocks, gather, hashes, lists, mix, powers, words
from patronage.session import remove, written, written_at

WINDOW = 20
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1

_ODD = 0x9E3779B97F4A7C15
_UNDO = pow(_ODD, -1, 1 << 64)
_EMPTY = hashlib.sha256(b"").hexdigest()


class Spans:
    """Names of any span of consecutive words of a block."""

    def __init__(self, value: np.ndarray):
        self.totals = []
        for salt in (0, 0xD1B54A32D192ED03):
            total = np.zeros(len(value) + 1, np.uint64)
            np.cumsum(mix(value ^ np.uint64(salt)) * powers(_ODD, len(value)), out=total[1:])
            self.totals.append(total)
        self.undo = powers(_UNDO, len(value) + 1)

    def name(self, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = self.totals[which]
        spread = (total[end] - total[begin]) * self.undo[begin] + (end - begin).astype(np.uint64)
        return mix(spread).astype(np.int64)


def anchor_places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions of documents of ``n`` words, one after another, and how many each has."""
    each = np.stack([np.maximum(0, (n - ANCHOR - c) // PERIOD + 1) for c in COVER], axis=1)
    each[n < WINDOW] = 0
    counts = each.sum(axis=1)
    order = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    # Position number j of a document: the (j % 3)-th of the cover in period j // 3.
    return (order // len(COVER)) * PERIOD + np.array(COVER)[order % len(COVER)], counts


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[bytes]:
    """The words of every row with one space between them."""
    lengths = end - begin + 1
    flat = np.full(int(lengths.sum()), 0x20, np.uint8)
    place = np.cumsum(lengths) - lengths
    flat[gather(place, lengths - 1)] = data[gather(begin, lengths - 1)]
    ends = np.concatenate([place, [len(flat)]])
    raw = flat.tobytes()
    return [raw[ends[f] : ends[f + c] - 1] if c else b"" for f, c in zip(first.tolist(), count.tolist())]


def sketches(docs: DataFrame, doc_id: str, text: str, texts: bool) -> DataFrame:
    """``doc, n, k1, k2, digest, anchors, body`` of every row; names and anchors only from ``WINDOW`` words on."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in blocks(batch.column(1)):
                begin, end, owner = words(data, starts)
                n = np.bincount(owner, minlength=len(starts) - 1)
                first = np.cumsum(n) - n
                spans = Spans(hashes(data, begin, end))
                places, counts = anchor_places(n)
                at = places + np.repeat(first, counts)
                bodies = _joined(data, begin, end, first, n)
                none = n < WINDOW
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)), pa.array(n, pa.int64()),
                        *[pa.array(spans.name(i, first, first + n), mask=none) for i in (0, 1)],
                        pa.array([hashlib.sha256(b).hexdigest() for b in bodies]),
                        lists(spans.name(0, at, at + ANCHOR), counts, pa.int64()),
                        pa.array([b.decode() if texts else None for b in bodies], pa.string()),
                    ],
                    names=["doc", "n", "k1", "k2", "digest", "anchors", "body"],
                )

    schema = f"doc {kind}, n long, k1 long, k2 long, digest string, anchors array<long>, body string"
    return docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(run, schema)


def _posts(sketch: DataFrame) -> DataFrame:
    """``hash, k1, k2, pos, doc`` of the anchors whose hash occurs more than once, one row per class and position."""
    often = sketch.select(F.explode("anchors").alias("hash")).groupBy("hash").count().where("count > 1")
    shared = bitmap(often.select("hash"), "hash")
    kind = sketch.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            value = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            places, counts = anchor_places(n)
            at = np.flatnonzero(held(shared.value, value))
            row = pa.array(np.repeat(np.arange(len(n)), counts)[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value[at]), batch.column(2).take(row), batch.column(3).take(row),
                    pa.array(places[at].astype(np.int32)), batch.column(0).take(row),
                ],
                names=["hash", "k1", "k2", "pos", "doc"],
            )

    long = sketch.where(F.col("n") >= WINDOW).select("doc", "n", "k1", "k2", "anchors")
    found = long.mapInArrow(run, f"hash long, k1 long, k2 long, pos int, doc {kind}")
    least = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("d")
    return found.groupBy("hash", "k1", "k2", "pos").agg(least).select("hash", "k1", "k2", "pos", "d.none", "d.doc")


def _hits(posts: DataFrame) -> tuple[DataFrame, str]:
    """Per class its anchors that occur elsewhere too, with their earliest occurrence; and a table to remove."""
    spot = F.struct("k1", "k2", "pos")
    firsts, path = written_at(
        posts.groupBy("hash")
        .agg(F.min(F.struct("none", "doc", "k1", "k2", "pos")).alias("f"), F.min(spot).alias("x"), F.max(spot).alias("y"))
        .where("x <> y")
        .select("hash", F.col("f.k1").alias("f1"), F.col("f.k2").alias("f2"), F.col("f.pos").alias("fp")),
        "repeats-firsts",
    )
    hits = (
        posts.join(firsts, "hash")
        .groupBy("k1", "k2", "none", "doc")
        .agg(F.collect_list(F.struct("pos", "f1", "f2", "fp")).alias("hits"))  # of one document, of its own length
    )
    return hits, path


def _bodies(docs: DataFrame, hits: DataFrame, text: str) -> DataFrame:
    """``k1, k2, body``: the words of the classes with hits, made from the texts again."""
    wanted = bitmap(hits.select("k1"), "k1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, starts in blocks(batch.column(0)):
                begin, end, owner = words(data, starts)
                n = np.bincount(owner, minlength=len(starts) - 1)
                first = np.cumsum(n) - n
                spans = Spans(hashes(data, begin, end))
                k1, k2 = (spans.name(i, first, first + n) for i in (0, 1))
                at = np.flatnonzero((n >= WINDOW) & held(wanted.value, k1))
                # Copies within a block give one row.
                at = at[np.unique(k1[at], return_index=True)[1]]
                bodies = _joined(data, begin, end, first[at], n[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[at]), pa.array(k2[at]), pa.array([b.decode() for b in bodies], pa.string())],
                    names=["k1", "k2", "body"],
                )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "k1 long, k2 long, body string").dropDuplicates(["k1", "k2"])


class Judged:
    """The windows of a block of suspects: repeated for certain, open, or possible sources of open ones."""

    def __init__(self, n, first, row, pos, f1, f2, fp, k1, k2):
        size = int(n.sum())
        own = (f1 == k1[row]) & (f2 == k2[row]) & (fp == pos)
        back = ~own
        self.repeated = np.zeros(size, bool)
        r, p, a, b, shift = (x[back] for x in (row, pos, f1, f2, pos - fp))
        if len(r):
            order = np.lexsort((p, shift, b, a, r))
            r, p, a, b, shift = (x[order] for x in (r, p, a, b, shift))
            new = np.ones(len(r), bool)
            same = (r[1:] == r[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (shift[1:] == shift[:-1])
            new[1:] = ~same | (p[1:] > p[:-1] + ANCHOR)
            start = np.flatnonzero(new)
            last = np.append(start[1:], len(r)) - 1
            # Windows inside a run.
            count = np.maximum(0, p[last] + ANCHOR - WINDOW + 1 - p[start])
            self.repeated[gather(first[r[start]] + p[start], count)] = True
        self.touched = self._around(n, first, row, pos, size)
        self.open = self._around(n, first, row[back], pos[back], size) & ~self.repeated
        self.sources = self.touched & ~self.repeated

    @staticmethod
    def _around(n, first, row, pos, size) -> np.ndarray:
        """The windows that hold one of these anchors."""
        low = np.maximum(pos - (PERIOD - 1), 0)
        high = np.minimum(pos, n[row] - WINDOW)
        marks = np.zeros(size, bool)
        marks[gather(first[row] + low, np.maximum(high - low + 1, 0))] = True
        return marks


def _suspect_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per block of ``k1, k2, body, hits, …``: its batch, words and judged windows."""
    for batch in batches:
        for row, data, starts in blocks(batch.column(2)):
            part = batch.slice(row, len(starts) - 1)
            begin, end, owner = words(data, starts)
            n = np.bincount(owner, minlength=len(starts) - 1)
            first = np.cumsum(n) - n
            k1, k2 = (part.column(i).to_numpy() for i in (0, 1))
            hits = part.column(3)
            counts = np.diff(hits.offsets.to_numpy())
            inner = hits.flatten()
            pos, f1, f2, fp = (x.to_numpy(zero_copy_only=False) for x in inner.flatten())
            at = np.repeat(np.arange(len(n)), counts)
            judged = Judged(n, first, at, pos.astype(np.int64), f1, f2, fp.astype(np.int64), k1, k2)
            yield part, data, begin, end, owner, n, first, judged


def _windows(suspects: DataFrame) -> DataFrame:
    """``h1, h2, none, doc, k1, k2, pos, open`` of all windows over repeated anchors that no run has settled."""
    kind = suspects.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, begin, end, owner, n, first, judged in _suspect_blocks(batches):
            spans = Spans(hashes(data, begin, end))
            at = np.flatnonzero(judged.sources)
            row = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(spans.name(i, at, at + WINDOW)) for i in (0, 1)],
                    part.column(4).take(row), part.column(5).take(row), part.column(0).take(row),
                    part.column(1).take(row), pa.array((at - first[owner[at]]).astype(np.int32)),
                    pa.array(judged.open[at]),
                ],
                names=["h1", "h2", "none", "doc", "k1", "k2", "pos", "open"],
            )

    rows = suspects.select("k1", "k2", "body", "hits", "none", "doc")
    schema = f"h1 long, h2 long, none boolean, doc {kind}, k1 long, k2 long, pos int, open boolean"
    return rows.mapInArrow(run, schema)


def _later(windows: DataFrame) -> tuple[DataFrame, str]:
    """``k1, k2, starts``: the open windows of every class that have an earlier equal one; and a table to remove."""
    firsts, path = written_at(
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("none", "doc", "k1", "k2", "pos")).alias("f"), F.max("open").alias("any"), F.count(F.lit(1)).alias("times"))
        .where("any AND times > 1")
        .select("h1", "h2", F.struct("f.k1", "f.k2", "f.pos").alias("f")),
        "repeats-sources",
    )
    later = (
        windows.where("open")
        .join(firsts, ["h1", "h2"])
        .where(F.struct("k1", "k2", "pos") != F.col("f"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("pos").alias("starts"))
    )
    return later, path


def _cut(suspects: DataFrame, later: DataFrame, texts: bool) -> DataFrame:
    """``k1, k2, n_removed, digest, removed, body``: what stays of every class with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, begin, end, owner, n, first, judged in _suspect_blocks(batches):
            starts = part.column(4)
            counts = np.diff(starts.offsets.to_numpy())
            found = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            judged.repeated[np.repeat(first, counts) + found] = True
            opened = np.flatnonzero(judged.repeated)
            change = np.zeros(len(owner) + 1, np.int64)
            change[opened] += 1
            change[opened + WINDOW] -= 1
            gone = np.cumsum(change[:-1]) > 0
            left = np.flatnonzero(~gone)
            stays = np.bincount(owner[left], minlength=len(n))
            bodies = _joined(data, begin[left], end[left], np.cumsum(stays) - stays, stays)
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            # Runs of removed words, cut where a document ends.
            border = np.zeros(len(owner) + 1, bool)
            border[first[n > 0]] = True
            here = np.append(gone, False)
            before = np.concatenate([[False], gone])
            low = np.flatnonzero(here & ((edge == 1) | border))
            high = np.flatnonzero(before & ((edge == -1) | border))
            spans = np.bincount(owner[low], minlength=len(n))
            offsets = np.concatenate([[0], np.cumsum(spans)]).astype(np.int32)
            base = first[owner[low]]
            removed = pa.ListArray.from_arrays(
                pa.array(offsets),
                pa.StructArray.from_arrays(
                    [pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32))], ["start", "end"]
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(n - stays, pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in bodies]), removed,
                    pa.array([b.decode() if texts else None for b in bodies], pa.string()),
                ],
                names=["k1", "k2", "n_removed", "left_digest", "removed", "left"],
            )

    rows = suspects.join(later, ["k1", "k2"], "left").select(
        "k1", "k2", "body", "hits", F.coalesce("starts", F.array().cast("array<int>")).alias("starts")
    )
    schema = "k1 long, k2 long, n_removed long, left_digest string, removed array<struct<start:int,end:int>>, left string"
    return rows.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256, removed`` and, if asked for, ``kept_text``.

    ``removed`` lists the removed spans of words as ``(start, end)``; the kept words
    are joined by one space. Writes and runs jobs when called.
    """
    spark = docs.sparkSession
    # Tables are removed as soon as what is made from them is written.
    anchored, anchors_path = written_at(
        sketches(docs, doc_id, text, texts).withColumn("row", F.monotonically_increasing_id()), "repeats-anchors"
    )
    posts, posts_path = written_at(_posts(anchored), "repeats-posts")
    sketch = written(anchored.drop("anchors"), "repeats-sketches")
    remove(spark, anchors_path)
    found, firsts_path = _hits(posts)
    hits, hits_path = written_at(found, "repeats-hits")
    for path in (posts_path, firsts_path):
        remove(spark, path)
    suspects, suspects_path = written_at(_bodies(docs, hits, text).join(hits, ["k1", "k2"]), "repeats-suspects")
    remove(spark, hits_path)
    windows, windows_path = written_at(_windows(suspects), "repeats-windows")
    later, sources_path = _later(windows)
    starts, starts_path = written_at(later, "repeats-later")
    for path in (windows_path, sources_path):
        remove(spark, path)
    cut = written(_cut(suspects, starts, texts), "repeats-cut")
    for path in (suspects_path, starts_path):
        remove(spark, path)
    classes = (
        sketch.where("k1 IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row")).alias("one"))
        .select("k1", "k2", F.col("one.row").alias("one"))
    )
    named = written(classes.join(cut, ["k1", "k2"], "left"), "repeats-classes")
    rows = sketch.select("doc", "n", "k1", "k2", "digest", "body", "row").join(named, ["k1", "k2"], "left")
    copy = F.col("one").isNotNull() & (F.col("one") != F.col("row"))
    span = F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def choose(of_copy: Column, left: str, whole: Column) -> Column:
        return F.when(copy, of_copy).otherwise(F.coalesce(F.col(left), whole))

    columns = [
        F.col("doc").alias(doc_id), F.col("n").alias("n_words"),
        choose(F.col("n"), "n_removed", F.lit(0).cast("long")).alias("n_removed"),
        choose(F.lit(_EMPTY), "left_digest", F.col("digest")).alias("kept_sha256"),
        choose(F.array(span), "removed", none).alias("removed"),
    ]
    if texts:
        columns.append(choose(F.lit(""), "left", F.col("body")).alias("kept_text"))
    return rows.select(*columns)
