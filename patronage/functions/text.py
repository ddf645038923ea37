"""Text expressions used for matching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, _EDGE_BLANKS, "")


def normal_email(email: Column) -> Column:
    return F.replace(strip(F.lower(F.coalesce(email, F.lit("")))), F.lit(" "), F.lit(""))


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\D", "")


def normal_name(name: Column) -> Column:
    return strip(F.lower(F.coalesce(name, F.lit(""))))


def block_letter(normal: Column) -> Column:
    """Upper-case first character; null for an empty name, so that it joins with nothing."""
    return F.nullif(F.upper(F.substring(normal, 1, 1)), F.lit(""))


def similarity_ceiling(left: Column, right: Column) -> Column:
    """An upper bound of the Jaro-Winkler similarity from the two lengths alone."""
    a, b = F.length(left), F.length(right)
    jaro = (F.lit(2.0) + F.least(a, b) / F.greatest(a, b, F.lit(1))) / 3.0
    return F.when((a == 0) | (b == 0), 0.0).otherwise(jaro + (F.lit(1.0) - jaro) * 0.4 + 1e-9)


# Cells of the character tables built at once: bounds memory when texts are long.
_CELLS = 1 << 21


def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of a batch of text pairs; 0 when either is empty."""
    a, b = left.to_numpy(dtype=object), right.to_numpy(dtype=object)
    len_a = np.fromiter(map(len, a), dtype=np.int64, count=len(a))
    len_b = np.fromiter(map(len, b), dtype=np.int64, count=len(b))
    result = np.where((a == b) & (len_a > 0), 1.0, 0.0)
    todo = np.flatnonzero((len_a > 0) & (len_b > 0) & (result == 0.0))
    width = np.maximum(len_a, len_b)
    todo = todo[np.argsort(width[todo], kind="stable")]
    while todo.size:
        # Ascending widths: take as many rows as stay within the cell budget.
        fits = np.flatnonzero(width[todo] * np.arange(1, todo.size + 1) <= _CELLS)
        take = max(1, fits[-1] + 1 if fits.size else 1)
        part, todo = todo[:take], todo[take:]
        result[part] = _compare(a[part], b[part], len_a[part], len_b[part])
    return pd.Series(result)


def _characters(texts: np.ndarray) -> np.ndarray:
    table = np.array(texts, dtype=str)
    return table.view(np.uint32).reshape(len(table), -1)


def _compare(a, b, len_a, len_b) -> np.ndarray:
    chars_a, chars_b = _characters(a), _characters(b)
    n, wide_b = chars_b.shape
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    at_b = np.arange(wide_b)
    free = at_b < len_b[:, None]
    hit_a = np.zeros(chars_a.shape, dtype=bool)
    for i in range(chars_a.shape[1]):
        lo, hi = max(0, i - int(reach.max())), min(wide_b, i + int(reach.max()) + 1)
        if lo >= hi:
            break
        fit = (
            (chars_b[:, lo:hi] == chars_a[:, i, None])
            & free[:, lo:hi]
            & (np.abs(at_b[lo:hi] - i) <= reach[:, None])
            & (i < len_a)[:, None]
        )
        rows = np.flatnonzero(fit.any(axis=1))
        free[rows, lo + fit[rows].argmax(axis=1)] = False
        hit_a[rows, i] = True
    hit_b = ~free & (at_b < len_b[:, None])
    common = hit_a.sum(axis=1)
    order_a, order_b = _in_order(chars_a, hit_a), _in_order(chars_b, hit_b)
    deep = min(order_a.shape[1], order_b.shape[1])
    swapped = (order_a[:, :deep] != order_b[:, :deep]).sum(axis=1) // 2
    some = np.maximum(common, 1)
    jaro = (common / len_a + common / len_b + (common - swapped) / some) / 3.0
    jaro = np.where(common > 0, jaro, 0.0)
    head = min(4, chars_a.shape[1], wide_b)
    same = (chars_a[:, :head] == chars_b[:, :head]) & (np.arange(head) < np.minimum(len_a, len_b)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)


def _in_order(chars: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """The matched characters of each row moved to the front, zeros after them."""
    packed = np.zeros((len(chars), max(1, int(hit.sum(axis=1).max(initial=0)))), dtype=np.uint32)
    rows, cols = np.nonzero(hit)
    packed[rows, (np.cumsum(hit, axis=1) - 1)[rows, cols]] = chars[rows, cols]
    return packed


class Compared:
    """Texts that many others are compared with, all with all: see :meth:`with_all`.

    A text is, per character, the bits of the places that have it, so one step of the
    comparison is a few integer operations on a whole table of pairs.
    """

    def __init__(self, texts: np.ndarray, coded: bool = False):
        """``texts``: strings, in an object array; each of them once is enough. Quickest if they come by length.

        With ``coded``, comparisons give places in ``values``, the list of the similarities met so far.
        """
        self.texts = texts
        self.coded = coded
        self.values, self._place, self._known = [0.0], {0.0: 0}, {}
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.groups = []
        for length in np.unique(lengths[(lengths > 0) & (lengths <= _LONGEST)]):
            at = np.flatnonzero(lengths == length)
            kind = np.uint16 if length <= 16 else np.uint32 if length <= 32 else np.uint64
            # As many texts at once as the table of their characters has room for.
            most = max(1, 4 * _CELLS // (len(np.unique(_characters(texts[at]))) + 1))
            for start in range(0, len(at), most):
                some = at[start : start + most]
                letters, codes = np.unique(_characters(texts[some]), return_inverse=True)
                codes = codes.reshape(len(some), length)
                places = np.zeros((len(letters) + 1, len(some)), dtype=kind)  # the last row: any other character
                for j in range(length):
                    places[codes[:, j], np.arange(len(some))] |= kind(1 << j)
                self.groups.append((int(length), some, letters, places))
        self.longer = np.flatnonzero(lengths > _LONGEST)

    def with_all(self, left: np.ndarray) -> np.ndarray:
        """The similarity of every text of ``left`` (rows) and every one of these (columns), as by :func:`similarity`."""
        result = np.zeros((len(left), len(self.texts)), dtype=np.int32 if self.coded else np.float64)
        lengths = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
        for length in np.unique(lengths[(lengths > 0) & (lengths <= _LONGEST)]):
            at = np.flatnonzero(lengths == length)
            chars = _characters(left[at])
            for wide, some, letters, places in self.groups:
                known = self._outcomes(int(length), wide)
                codes = np.minimum(np.searchsorted(letters, chars), len(letters) - 1)
                codes = np.where(letters[codes] == chars, codes, len(letters))
                rows = max(1, _TABLE // len(some))
                for start in range(0, len(at), rows):
                    part = slice(start, start + rows)
                    found = np.take(known, _compare_all(codes[part], int(length), wide, places), mode="clip")
                    if _consecutive(at[part]) and _consecutive(some):
                        result[at[start] : at[start] + len(found), some[0] : some[-1] + 1] = found
                    else:
                        result[np.ix_(at[part], some)] = found
        for i in np.flatnonzero(lengths > _LONGEST):
            result[i] = self._kept(similarity(pd.Series([left[i]] * len(self.texts)), pd.Series(self.texts)).to_numpy())
        for j in self.longer:
            result[:, j] = self._kept(similarity(pd.Series(left), pd.Series([self.texts[j]] * len(left))).to_numpy())
        return result

    def _outcomes(self, len_a: int, len_b: int) -> np.ndarray:
        """What the outcomes of :func:`_compare_all` stand for."""
        if (len_a, len_b) not in self._known:
            prefix = [np.cumprod([x >> j & 1 for j in range(4)]).sum() for x in range(16)]
            self._known[len_a, len_b] = self._kept(outcomes(len_a, len_b)[:, :, prefix].ravel())
        return self._known[len_a, len_b]

    def _kept(self, similarities: np.ndarray) -> np.ndarray:
        if not self.coded:
            return similarities
        distinct, at = np.unique(similarities, return_inverse=True)
        for value in distinct.tolist():
            if value not in self._place:
                self._place[value] = len(self.values)
                self.values.append(value)
        return np.array([self._place[value] for value in distinct.tolist()], dtype=np.int32)[at]


# Pairs compared at once: what stays in a core's cache. Longer texts than fit a word of bits go pair by pair.
_TABLE = 1 << 15
_LONGEST = 64


def _consecutive(numbers: np.ndarray) -> bool:
    return numbers[-1] - numbers[0] + 1 == len(numbers)


def _compare_all(codes: np.ndarray, len_a: int, len_b: int, places: np.ndarray) -> np.ndarray:
    """:func:`_compare` of all pairs of texts of one length each, by outcome; ``codes`` are rows of ``places``."""
    kind = places.dtype.type
    shape = len(codes), places.shape[1]
    full = (1 << len_b) - 1
    reach = max(max(len_a, len_b) // 2 - 1, 0)
    steps = min(len_a, len_b + reach)  # farther places of a reach nothing
    free = np.full(shape, full, dtype=kind)
    head, wrong = np.zeros(shape, dtype=kind), np.zeros(shape, dtype=kind)
    same, low = np.empty(shape, dtype=kind), np.empty(shape, dtype=kind)
    found, hit = np.empty((steps, *shape), dtype=kind), np.empty(shape, dtype=bool)
    signed = np.dtype(f"i{places.itemsize}")  # negated faster
    for i in range(steps):
        np.take(places, codes[:, i], axis=0, out=same, mode="clip")
        if i < 4:
            np.bitwise_and(same, kind((1 << i) & full), out=low)
            head |= low
        same &= free
        same &= kind(((1 << (i + reach + 1)) - 1) & ~((1 << max(0, i - reach)) - 1) & full)
        np.not_equal(same, kind(0), out=hit)
        np.copyto(found[i], hit)
        np.negative(same.view(signed), out=low.view(signed))
        low &= same
        free ^= low
    taken = free ^ kind(full)
    common = _ones(taken)
    for i in range(steps):
        # The next taken place of b should have the character of this matched place of a.
        np.negative(taken.view(signed), out=low.view(signed))
        low &= taken
        low *= found[i]
        taken ^= low
        np.take(places, codes[:, i], axis=0, out=same, mode="clip")
        same &= low
        low ^= same
        wrong |= low
    # Few outcomes: by matches, places out of order, equal first characters.
    most = min(len_a, len_b)
    outcome = (common * np.uint16(most // 2 + 1) + (_ones(wrong) >> np.uint16(1))) * np.uint16(16) + head.astype(np.uint16)
    return outcome.astype(np.intp)


def _ones(bits: np.ndarray) -> np.ndarray:
    # Counted in words of 32 bits or more, which is faster.
    return np.bitwise_count(bits if bits.itemsize > 2 else bits.astype(np.uint32)).astype(np.uint16)


class Matches:
    """Short texts over few characters that many others are matched with, see :meth:`rows`.

    Characters match only their like, so the matched places of a pair are those of each character, put together, and
    those of a character depend on its places in both texts alone. They are found once for each set of places that
    a character has on the left, with all right texts; a left text then adds up one such row per distinct character.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, letters: int):
        """``codes`` as by :func:`coded`, of ``letters`` characters."""
        self.n, self.letters, self.sets = len(codes), letters, []
        for places in places_of(codes, lengths, letters):
            # The few sets of places that a character has in texts of each length.
            distinct, at = np.unique(places.astype(np.int64) << 4 | lengths, return_inverse=True)
            self.sets.append(((distinct >> 4).astype(np.uint32), distinct & 15, at))

    def rows(self, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Rows of matches, the number of matches in them, and which rows each left text adds up; these are of one length.

        A match row has, per right text, the matched places of the right text in the lowest 14 bits, those of the left text
        in the next 14 and their number in the highest 4.
        """
        chosen = np.full((len(codes), self.letters), -1, dtype=np.int64)
        left = [np.unique(sets, return_inverse=True) for sets in places_of(codes, np.full(len(codes), length), self.letters)]
        table = np.empty((sum(len(distinct) for distinct, _ in left), self.n), dtype=np.uint32)
        counts = np.empty(table.shape, dtype=np.uint8)
        used = 0
        for c, ((distinct, at), (free, lengths, place)) in enumerate(zip(left, self.sets)):
            if not free.any():
                continue
            reach = np.maximum(np.maximum(length, lengths) // 2 - 1, 0)
            windows = [((1 << (i + reach + 1)) - 1) & ~((1 << np.maximum(i - reach, 0)) - 1) for i in range(length)]
            # A set goes on from the set without its last place: free places of the right texts, and matches.
            known = {0: (free, np.zeros(len(free), np.uint32))}
            numbers = np.full(len(distinct), -1, dtype=np.int64)
            for k, places in enumerate(distinct.tolist()):
                if places:
                    matched = _matched(places, known, windows)[1]
                    np.take(matched, place, out=table[used], mode="clip")
                    np.take((matched >> np.uint32(2 * SHORT)).astype(np.uint8), place, out=counts[used], mode="clip")
                    numbers[k] = used
                    used += 1
            chosen[:, c] = numbers[at]
        return table, counts, [[r for r in row if r >= 0] for row in chosen.tolist()]


def _matched(places: int, known: dict, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if places not in known:
        i = places.bit_length() - 1
        free, matched = _matched(places ^ (1 << i), known, windows)
        low = free & windows[i].astype(np.uint32)
        low &= np.negative(low.view(np.int32)).view(np.uint32)
        hit = (low != 0).astype(np.uint32)
        hit *= np.uint32((1 << (SHORT + i)) + (1 << 2 * SHORT))
        hit += matched
        hit += low
        known[places] = free ^ low, hit
    return known[places]


# The longest texts of Matches, and the most characters: what their bits have room for.
SHORT = 14
FEW = 16


def coded(texts: np.ndarray, lengths: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The characters of texts, as places in the sorted ``letters``; 0 after the end of a text."""
    table = np.zeros((len(texts), int(lengths.max(initial=0))), dtype=np.uint8)
    if len(letters):
        chars = _characters(texts)[:, : table.shape[1]]
        inside = np.arange(table.shape[1]) < lengths[:, None]
        table[inside] = np.searchsorted(letters.astype(str).view(np.uint32), chars[inside])
    return table


def places_of(codes: np.ndarray, lengths: np.ndarray, letters: int) -> np.ndarray:
    """Per letter and text, the bits of the places that have it."""
    places = np.zeros((letters, len(codes)), dtype=np.uint32)
    for j in range(codes.shape[1]):
        longer = np.flatnonzero(lengths > j)
        places[codes[longer, j], longer] |= np.uint32(1 << j)
    return places


class Picked:
    """The characters of a text at given places, in order, four bits each; see :meth:`at`."""

    def __init__(self, codes: np.ndarray):
        n, length = codes.shape
        self.half = max(1, (length + 1) // 2)
        self.first, self.second = (self._table(codes[:, a:b]) for a, b in ((0, self.half), (self.half, length)))

    def _table(self, codes: np.ndarray) -> np.ndarray:
        """For each text and set of places: its characters there, and four times their number in the highest bits."""
        table = np.zeros((len(codes), 1 << self.half), dtype=np.uint32)
        for j in range(codes.shape[1]):
            # Sets with place j as their last follow those of earlier places only.
            before = table[:, : 1 << j]
            shift = (before >> np.uint32(28)) * np.uint32(4)
            table[:, 1 << j : 2 << j] = (before + np.uint32(1 << 28)) | (codes[:, j, None].astype(np.uint32) << shift)
        return table.ravel()

    def at(self, texts: np.ndarray | int, places: np.ndarray) -> np.ndarray:
        start = texts << self.half
        low = self.first.take(start + (places & ((1 << self.half) - 1)), mode="clip")
        high = self.second.take(start + (places >> self.half), mode="clip") & np.uint32((1 << 28) - 1)
        shift = (low >> np.uint32(28)) << np.uint32(2)
        return (low & np.uint32((1 << 28) - 1)) | (high.astype(np.uint64) << shift.astype(np.uint64))


def out_of_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Half the number of characters that differ between two picks of as many characters."""
    differ = left ^ right
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    differ &= np.uint64(0x1111111111111111)
    return np.bitwise_count(differ) >> np.uint8(1)


def outcomes(len_a: int, len_b: int) -> np.ndarray:
    """The similarity for each number of matches, of places out of order (halved) and of equal first characters."""
    most = min(len_a, len_b)
    m, s, h = np.arange(most + 1)[:, None, None], np.arange(most // 2 + 1)[None, :, None], np.arange(5)[None, None, :]
    jaro = np.where(m > 0, (m / max(1, len_a) + m / max(1, len_b) + (m - s) / np.maximum(m, 1)) / 3.0, 0.0)
    return np.where(jaro > 0.7, jaro + h * 0.1 * (1.0 - jaro), jaro)


# Declared non-deterministic, so that a filter on the score is not pushed below the
# projection: the similarity would be computed once for the filter and once more after it.
jaro_winkler = F.pandas_udf(similarity, T.DoubleType()).asNondeterministic()
