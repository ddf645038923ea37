"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

A text gets a leading space and is cut where a run of spaces begins; no piece
reaches over such a place (checked when the vocabulary is loaded), so the best
path of a text is the best paths of its segments in a row. Each distinct
segment of a block is segmented once, all of them in one pass over positions.

Null text gives null ids, an empty one no ids. Ids of no piece, or of control
pieces, decode to nothing. Columns with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.pieces import Lattice, PieceTable, load_pieces
from patronage.llm.textbatch import blocks, gather, hashes, lists

IDS = T.ArrayType(T.IntegerType(), False)


def encode_block(table: PieceTable, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All piece ids of a block, and the number of them in each row."""
    rows = len(starts) - 1
    lengths = np.diff(starts)
    full = lengths > 0
    # One space ahead of each text that is not empty.
    shifted = starts + np.concatenate([[0], np.cumsum(full)])
    spaced = np.full(int(shifted[-1]), 0x20, np.uint8)
    spaced[gather(shifted[:-1] + full, lengths)] = data
    if not len(spaced):
        return np.zeros(0, np.int32), np.zeros(rows, np.int64)
    space = spaced == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[shifted[:-1][full]] = True
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(spaced))
    _, sample, inverse = np.unique(hashes(spaced, begin, end), return_index=True, return_inverse=True)
    ids, counts = best_paths(table, spaced, begin[sample], end[sample])
    before = np.cumsum(counts) - counts
    chosen = ids[gather(before[inverse], counts[inverse])]
    owner = np.searchsorted(shifted, begin, side="right") - 1
    return chosen, np.bincount(owner, weights=counts[inverse], minlength=rows).astype(np.int64)


def best_paths(
    table: PieceTable, data: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the best segmentation of every span, and their numbers."""
    lattice = Lattice(data, begin, end)
    best = np.full(lattice.cells, -np.inf)
    best[lattice.slot] = 0.0
    back = np.zeros(lattice.cells, np.int32)  # bytes of the piece that ends here
    piece = np.full(lattice.cells, -1, np.int32)
    unknown = table.unknown
    for i, reach in enumerate(lattice.reach):
        lead = data[lattice.start[:reach] + i]
        rows = np.flatnonzero((lead & 0xC0) != 0x80)  # pieces start with characters
        if not len(rows):
            continue
        lead = lead[rows]
        width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
        width = np.minimum(width, lattice.length[rows] - i)
        here = best[lattice.slot[rows] + i]
        score = np.zeros(reach)
        score[rows] = here
        single = np.zeros(reach, dtype=bool)
        size = np.zeros(reach, np.int64)
        size[rows] = width
        for hit, found, depth in lattice.walk(table, rows, i):
            _relax(best, back, piece, lattice.slot[hit] + i + depth, score[hit] + table.scores[found], depth, found)
            single[hit[size[hit] == depth]] = True
        alone = ~single[rows]
        if alone.any():
            bare = rows[alone]
            _relax(best, back, piece, lattice.slot[bare] + i + width[alone], score[bare] + unknown, width[alone], -1)
    # From the ends back: the piece of a path is noted where it starts.
    at = np.full(lattice.cells, -1, np.int32)
    position = lattice.length.copy()
    rows = np.arange(len(position))
    while len(rows):
        cell = lattice.slot[rows] + position[rows]
        step, found = back[cell].astype(np.int64), piece[cell]
        known = found >= 0
        at[(cell - step)[known]] = found[known]
        bare, spans = (cell - step)[~known], step[~known]
        if len(bare):
            cells = gather(bare, spans)
            source = gather((lattice.start[rows] + position[rows] - step)[~known], spans)
            at[cells] = table.byte_ids[data[source]]
        position[rows] -= step
        rows = rows[position[rows] > 0]
    # Back to the order in which the spans came.
    sums = np.concatenate([[0], np.cumsum(at >= 0)])
    counts = sums[lattice.slot + lattice.length] - sums[lattice.slot]
    ids, first = at[at >= 0], sums[lattice.slot]
    inverse = np.argsort(lattice.order)
    counts, first = counts[inverse], first[inverse]
    return ids[gather(first, counts)], counts


def _relax(best, back, piece, cell, score, step, found) -> None:
    better = score > best[cell]
    if better.any():
        to = cell[better]
        best[to] = score[better]
        back[to] = step if np.isscalar(step) else step[better]
        piece[to] = found if np.isscalar(found) else found[better]


class Decoder:
    """Piece texts laid out flat, to join the pieces of a whole batch in one gather."""

    def __init__(self, table: PieceTable):
        self.length = np.array([len(t) for t in table.texts] + [0], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(table.texts), np.uint8)

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Text of each run of ``counts`` ids; bytes that are no UTF-8 become U+FFFD."""
        ids = np.where((ids >= 0) & (ids < len(self.length) - 1), ids, len(self.length) - 1)
        lengths = self.length[ids]
        data = self.flat[gather(self.start[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        out, at = [], 0
        for end in ends.tolist():
            out.append(data[at:end].removeprefix(b" ").decode("utf-8", "replace"))
            at = end
        return out


def check_boundaries(table: PieceTable) -> PieceTable:
    """Refuse a vocabulary with a piece that goes from a character on to a marker, or lacks bytes."""
    if any(b" " in text.lstrip(b" ") for text in table.texts if len(text) > 1):
        raise ValueError("a piece has the whitespace marker after another character")
    if (table.byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte fallback")
    return table


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``docs`` with the piece ids of ``text`` in a column ``ids``."""
    table = docs.sparkSession.sparkContext.broadcast(check_boundaries(load_pieces(model_file)))
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, IDS)])
    names, place = [*kept.columns, ids], kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            for row, data, starts in blocks(column):
                found, counts = encode_block(table.value, data, starts)
                part = batch.slice(row, len(starts) - 1)
                made = lists(found, counts, pa.int32())
                if part.column(place).null_count:
                    missing = part.column(place).is_null()
                    made = pa.ListArray.from_arrays(made.offsets, made.values, mask=missing)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=names)

    return kept.mapInArrow(run, schema)


def decode(pieces: DataFrame, model_file: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``pieces`` with the text of ``ids`` in a column ``text``."""
    table = pieces.sparkSession.sparkContext.broadcast(load_pieces(model_file))
    kept = pieces.drop(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])
    names, place = [*kept.columns, text], kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(table.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                column = part.column(place)
                values = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                made = decoder.texts(values.astype(np.int64), counts.astype(np.int64))
                made = pa.array(made, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=names)

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """Encode and decode every text: number of ids, a digest of them, and whether the text came back.

    ``doc_id, n_pieces, n_byte_pieces, ids_sha256, round_trip``; null text has
    null figures and ``round_trip`` true.
    """
    table = load_pieces(model_file)
    low, high = int(table.byte_ids.min()), int(table.byte_ids.max())
    both = decode(encode(docs.select("doc_id", "text"), model_file), model_file)
    return both.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.size(F.filter("piece_ids", lambda x: (x >= low) & (x <= high))).cast("long").alias("n_byte_pieces"),
        F.sha2(F.array_join("piece_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    ).withColumns(
        {c: F.when(F.col("ids_sha256").isNotNull(), F.col(c)) for c in ("n_pieces", "n_byte_pieces")}
    )
