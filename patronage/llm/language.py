"""Language of the spans of mixed text: script ranges, word scores, and Viterbi with a switching penalty.

A word's scripts, told by code point ranges, leave the languages that were seen
with these scripts in training (all of them if none was). The word's score in a
language is the log likelihood of its byte 4-grams. Viterbi over the words of a
text, with a penalty for each change of language, labels spans. A text's
language is the one with the most bytes of words that hold a letter, the
smallest name in a tie; its score is that part of these bytes.

Training takes a bounded sample of about ``DOCS_PER_LANGUAGE`` documents of
each language, chosen by a hash. The model has ``BUCKETS`` figures per language.
Null texts and texts without a letter are ``und`` with score 0 and have no spans;
so are all texts if nothing is there to learn from. Columns that are named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.textbatch import LOWER, SPACE, blocks, gather, words

DOCS_PER_LANGUAGE = 3000
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
WORD_LIMIT = 8.0  # no word tells more than this between two languages
UNKNOWN = "und"

# First code points of the ranges of Unicode blocks, with their script.
RANGES = [
    (0x0000, "common"), (0x0041, "latin"), (0x005B, "common"), (0x0061, "latin"), (0x007B, "common"),
    (0x00C0, "latin"), (0x0250, "latin"), (0x02B0, "common"), (0x0370, "greek"), (0x0400, "cyrillic"),
    (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "common"), (0x2C00, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x1F000, "common"), (0x20000, "han"),
]
SCRIPTS = sorted({s for _, s in RANGES} - {"common"})
_FIRST = np.array([a for a, _ in RANGES])
_BIT = np.array([0 if s == "common" else 1 << SCRIPTS.index(s) for _, s in RANGES], np.int64)
_ASCII_BIT = _BIT[np.searchsorted(_FIRST, np.arange(128), side="right") - 1]


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]  # sorted
    scores: np.ndarray  # BUCKETS x languages, log likelihoods
    scripts: tuple[int, ...]  # of each language, the bits of its scripts

    def allowed(self, bits: np.ndarray) -> np.ndarray:
        """Languages left for words of the given script bits."""
        kinds, inverse = np.unique(bits, return_inverse=True)
        own = np.array(self.scripts, np.int64)
        left = (kinds[:, None] & ~own[None, :]) == 0
        left[~left.any(axis=1)] = True
        return left[inverse]


def script_bits(data: np.ndarray) -> np.ndarray:
    """Script bit of the character that starts at each byte; 0 inside of characters and for none."""
    bits = np.zeros(len(data), np.int64)
    low = data < 0x80
    bits[low] = _ASCII_BIT[data[low]]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = np.append(data, [0x80] * 3).astype(np.int64)
        first = b[lead]
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & np.array([0x1F, 0x0F, 0x07])[size - 2]
        for k in (1, 2, 3):
            code = np.where(size > k, (code << 6) | (b[lead + k] & 0x3F), code)
        bits[lead] = _BIT[np.searchsorted(_FIRST, code, side="right") - 1]
    return bits


def grams(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every 4-gram of every word with the space on both sides, and how many each word has."""
    padded = np.full(len(data) + 5, 0x20, np.uint32)
    padded[1 : len(data) + 1] = np.where(SPACE[data], 0x20, data)
    packed = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    bucket = ((packed * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    # The gram at i of the padded bytes covers the bytes i - 1 to i + 2.
    number = np.maximum(end - begin - 1, 1)
    return bucket[gather(begin, number)], number


def _or_at(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bits of all values in each word."""
    return np.bitwise_or.reduceat(values, np.column_stack([begin, np.maximum(end, begin + 1)]).ravel()[:-1])[::2]


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count 4-grams and scripts per language over the sample, on the executors."""
    given = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in given.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    names = tuple(sorted(sizes))
    if not names:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), ())
    part = F.lit(0.0)
    for name, size in sizes.items():
        part = F.when(F.col(lang) == name, min(1.0, DOCS_PER_LANGUAGE / size)).otherwise(part)
    chosen = given.where(F.pmod(F.xxhash64(doc_id, text), F.lit(1_000_000)) < part * 1_000_000)
    rows = chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for row, data, starts in blocks(batch.column(1)):
                data = LOWER[data]
                begin, end, owner = words(data, starts)
                if not len(begin):
                    continue
                bucket, number = grams(data, begin, end)
                bits = script_bits(data)
                names = np.array(batch.column(0).slice(row, len(starts) - 1).to_pylist(), object)
                of_gram = np.repeat(owner, number)
                of_byte = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                for name in set(names.tolist()):
                    mine = names == name
                    total = counts.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    total[:BUCKETS] += np.bincount(bucket[mine[of_gram]], minlength=BUCKETS)
                    seen = bits[mine[of_byte]]
                    for k in range(len(SCRIPTS)):
                        total[BUCKETS + k] += int((seen == 1 << k).sum())
        for name, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(total[at])], names=["lang", "bucket", "n"]
            )

    counted = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most (BUCKETS + scripts) rows per language
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(names)))
    place = {name: i for i, name in enumerate(names)}
    counts[found["bucket"].to_numpy(np.int64), found["lang"].map(place).to_numpy(np.int64)] = found["n"]
    smooth = counts[:BUCKETS] + 0.1
    scores = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    letters = counts[BUCKETS:]
    seen = letters > 0.01 * np.maximum(letters.sum(axis=0), 1)
    bits = tuple(int(sum(1 << k for k in range(len(SCRIPTS)) if seen[k, i])) for i in range(len(names)))
    return LanguageModel(names, scores, bits)


def word_scores(model: LanguageModel, data: np.ndarray, starts: np.ndarray):
    """``(begin, end, owner, has letter, scores)`` of the words of a block."""
    data = LOWER[data]
    begin, end, owner = words(data, starts)
    if not len(begin):
        return begin, end, owner, np.zeros(0, bool), np.zeros((0, len(model.names)), np.float32)
    bucket, number = grams(data, begin, end)
    total = np.add.reduceat(model.scores[bucket], np.cumsum(number) - number, axis=0)
    bits = _or_at(script_bits(data), begin, end)
    letter = bits > 0
    total -= total.max(axis=1, keepdims=True)
    np.maximum(total, -WORD_LIMIT, out=total)
    total[~model.allowed(bits)] = -2 * WORD_LIMIT
    total[~letter] = 0.0
    return begin, end, owner, letter, total


def viterbi(scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Best language of every word; texts are runs of ``counts`` words.

    All texts advance word by word together, the longest first in the arrays, so
    those that still have words are a leading part.
    """
    order = np.argsort(-counts, kind="stable")
    first, length = (np.cumsum(counts) - counts)[order], counts[order]
    longest = int(length[0]) if len(length) else 0
    reach = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    state = np.zeros(len(scores), np.int16)
    from_best = np.zeros(scores.shape, bool)
    best_before = np.zeros(len(scores), np.int16)
    value = np.zeros((len(length), scores.shape[1]), np.float32)
    for i, n in enumerate(reach):
        at = first[:n] + i
        v = value[:n]
        if i:
            top = v.argmax(axis=1)
            switched = v[np.arange(n), top][:, None] - np.float32(SWITCH_PENALTY)
            better = switched > v
            from_best[at], best_before[at] = better, top
            np.maximum(v, switched, out=v)
        v += scores[at]
    if longest:
        now = value.argmax(axis=1)
        for i in range(longest - 1, -1, -1):
            n = reach[i]
            at = first[:n] + i
            state[at] = now[:n]
            now[:n] = np.where(from_best[at, now[:n]], best_before[at], now[:n])
    return state


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]
    )
)


def label(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (byte offsets in UTF-8, and the language), ``lang_pred`` and ``score``."""
    kept = docs.drop("spans", "lang_pred", "score")
    if not model.names:
        none = {"spans": F.array().cast(SPANS), "lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}
        return kept.withColumns(none)
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = kept.withColumn("letter_lg", letter)
    schema = T.StructType(
        [
            *kept.schema.fields, T.StructField("spans", SPANS), T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    names, place, width = schema.names, kept.columns.index(text), len(kept.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS figures per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size = max(1 << 18, (8 << 20) // max(4, len(model.names)))
        for batch in batches:
            # Many texts advance together; a block's memory is its bytes times the languages.
            group, held = [], 0
            for block in blocks(batch.column(place), size):
                group.append((block[0], len(block[2]) - 1, np.diff(block[2]), *word_scores(model, *block[1:])))
                held += group[-1][-1].size
                if held > 8_000_000:
                    yield from _labelled(batch, group)
                    group, held = [], 0
            if group:
                yield from _labelled(batch, group)

    def _labelled(batch, group) -> Iterator[pa.RecordBatch]:
        model = shared.value
        row, rows = group[0][0], sum(g[1] for g in group)
        base = np.cumsum([0] + [g[1] for g in group])
        owner = np.concatenate([g[5] + b for g, b in zip(group, base)])
        begin, end = (np.concatenate([g[k] for g in group]) for k in (3, 4))
        # Offsets within the text: what lies before the text in its block goes off.
        starts = np.concatenate([np.cumsum(g[2]) - g[2] for g in group])
        letter = np.concatenate([g[6] for g in group])
        counts = np.bincount(owner, minlength=rows)
        part = batch.slice(row, rows)
        told = part.column(width).to_numpy(zero_copy_only=False)
        state = viterbi(np.concatenate([g[7] for g in group]), counts)
        weight = np.where(letter, end - begin, 0)
        mass = np.zeros((rows, len(model.names)))
        np.add.at(mass, (owner, state), weight)
        total = mass.sum(axis=1)
        top = mass.argmax(axis=1)
        # Letters outside of the ranges' scripts: all languages are level, the labels decide.
        plain = np.zeros((rows, len(model.names)))
        np.add.at(plain, (owner, state), 1)
        top = np.where(total > 0, top, plain.argmax(axis=1))
        lang = np.where(told, np.array(model.names, object)[top], UNKNOWN)
        score = np.where(told, mass[np.arange(rows), top] / np.maximum(total, 1), 0.0)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (state[1:] != state[:-1])
        at = np.flatnonzero(new)
        until = np.append(at[1:], len(owner)) - 1
        keep = told[owner[at]] if len(at) else np.zeros(0, bool)
        at, until = at[keep], until[keep]
        offset = starts[owner[at]]
        spans = _spans(begin[at] - offset, end[until] - offset, np.array(model.names, object)[state[at]])
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=rows))]).astype(np.int32)
        made = [pa.ListArray.from_arrays(pa.array(ends), spans), pa.array(lang, pa.string()), pa.array(score)]
        yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], names=names)

    def _spans(start, end, lang) -> pa.StructArray:
        columns = [pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(lang, pa.string())]
        return pa.StructArray.from_arrays(columns, names=["start", "end", "lang"])

    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_spans`` of every document."""
    found = label(docs.select("doc_id", "text"), fit(docs))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans")
    )
