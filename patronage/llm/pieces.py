"""A double-array trie over the pieces of a vocabulary, walked for many words at once.

The whitespace marker of the pieces is kept as the byte 0x20 and a text is read
with its own spaces, so a marker that stands in a text as a character is an
ordinary one (and comes out of the byte pieces unchanged).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

MARKER = "▁"

# Fixed values of the vocabulary format: how a byte piece is written.
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class PieceTable:
    """Pieces, their log scores, and the trie. Bounded by the vocabulary file."""

    texts: list[bytes]  # what a piece stands for in the text; empty for control pieces
    scores: np.ndarray  # natural logarithms
    byte_ids: np.ndarray  # piece of each byte value, -1 if there is none
    base: np.ndarray  # double array: the child of node s over byte c is base[s] + c ...
    check: np.ndarray  # ... if check[base[s] + c] == s
    piece_at: np.ndarray  # piece that ends in a node, or -1

    @property
    def unknown(self) -> float:
        """Score of a character that only byte pieces cover: below every piece."""
        return float(self.scores[self.piece_at[self.piece_at >= 0]].min()) - 10.0


def double_array(entries: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(base, check, value)`` of a trie over byte strings; node 0 is the root."""
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for text, entry in entries:
        node = 0
        for byte in text:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                value.append(-1)
            node = children[node][byte]
        value[node] = entry
    size = len(children) * 2 + 1024
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    out, taken = np.full(size, -1, np.int32), bytearray(size)
    taken[0], check[0] = 1, -2
    free, todo = 1, [(0, 0)]
    while todo:
        node, at = todo.pop()
        out[at] = value[node]
        own = sorted(children[node])
        if not own:
            base[at] = size  # past every slot: no byte leads on
            continue
        while taken[free]:
            free += 1
        slot, tries = max(free, own[0] + 1), 0
        while True:
            start = slot - own[0]
            if start + own[-1] >= len(taken):
                grow = len(taken)
                taken.extend(bytes(grow))
                base = np.concatenate([base, np.zeros(grow, np.int32)])
                check = np.concatenate([check, np.full(grow, -1, np.int32)])
                out = np.concatenate([out, np.full(grow, -1, np.int32)])
            if not any(taken[start + c] for c in own):
                break
            tries += 1
            if tries == 64 and len(own) > 1:
                free = slot  # what lies before is too full to be tried again
            slot += 1
            while slot < len(taken) and taken[slot]:
                slot += 1
            if slot >= len(taken):
                taken.extend(bytes(1024))
                base = np.concatenate([base, np.zeros(1024, np.int32)])
                check = np.concatenate([check, np.full(1024, -1, np.int32)])
                out = np.concatenate([out, np.full(1024, -1, np.int32)])
        base[at] = start
        for c in own:
            taken[start + c] = 1
            check[start + c] = at
            todo.append((children[node][c], start + c))
    # A node without children points past the end; 256 empty slots follow the last one.
    used = int(np.flatnonzero(np.frombuffer(bytes(taken), np.uint8))[-1]) + 1
    base, check, out = base[:used].copy(), check[:used], out[:used]
    base[base >= used] = used
    pad = np.full(256, -1, np.int32)
    return (
        np.concatenate([base, np.full(256, used, np.int32)]),
        np.concatenate([check, pad]),
        np.concatenate([out, pad]),
    )


def load_pieces(model_file: str) -> PieceTable:
    """Pieces of a SentencePiece model file with log scores.

    A unigram model's scores are log probabilities and are used as they are. A
    merge-ordered vocabulary has ranks instead of probabilities; its pieces get
    the logarithm of a Zipf law over the rank, normalised over the vocabulary.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.vocab_size()
    names = [model.id_to_piece(i) for i in range(size)]
    skip = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    byte_ids = np.full(256, -1, np.int32)
    texts = []
    for i, name in enumerate(names):
        found = BYTE_PIECE.fullmatch(name) if model.is_byte(i) else None
        if found:
            byte_ids[int(found[1], 16)] = i
            texts.append(bytes([int(found[1], 16)]))
        else:
            texts.append(b"" if i in skip else name.replace(MARKER, " ").encode())
    given = np.array([model.get_score(i) for i in range(size)])
    plain = [i for i in range(size) if i not in skip and not model.is_byte(i)]
    if np.exp(given[plain]).sum() < 2.0 and given[plain].min() > -100:
        scores = given
    else:
        scores = zipf_scores(size, plain)
    entries = [(texts[i], i) for i in plain if texts[i]]
    return PieceTable(texts, scores, byte_ids, *double_array(entries))


def zipf_scores(size: int, plain: list[int]) -> np.ndarray:
    """Log of a Zipf-Mandelbrot law over the order of ``plain``; other pieces get its least value."""
    weight = 1.0 / (np.arange(len(plain)) + 2.7)
    logs = np.log(weight / weight.sum())
    scores = np.full(size, logs.min())
    scores[plain] = logs
    return scores


class Lattice:
    """Spans of bytes laid out for recursions over all of them at a time.

    Spans are sorted by length, longest first: the spans that reach position
    ``i`` are then the first ``reach[i]`` ones.
    """

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        lengths = end - begin
        self.order = np.argsort(-lengths, kind="stable")
        self.length = lengths[self.order]
        self.start = begin[self.order]
        self.data = data
        self.slot = np.cumsum(self.length + 1) - (self.length + 1)  # length + 1 cells for each span
        self.cells = int((self.length + 1).sum())
        longest = int(self.length[0]) if len(self.length) else 0
        self.reach = np.searchsorted(-self.length, -np.arange(1, longest + 1), side="right")

    def walk(self, table: PieceTable, rows: np.ndarray, i: int):
        """Yield ``(rows, pieces, depth)`` for the pieces that start at ``i`` of the spans ``rows``."""
        node = np.zeros(len(rows), np.int32)
        depth = 0
        while len(rows):
            at = i + depth
            alive = self.length[rows] > at
            if not alive.all():
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    return
            to = table.base[node] + self.data[self.start[rows] + at]
            alive = table.check[to] == node
            rows, node = rows[alive], to[alive]
            depth += 1
            piece = table.piece_at[node]
            hit = piece >= 0
            if hit.any():
                yield rows[hit], piece[hit], depth
