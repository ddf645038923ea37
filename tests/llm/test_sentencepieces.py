"""Encoding next to the sentencepiece library on a unigram model with the same scores, and round trips."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from patronage.llm import sentencepieces as S
from patronage.llm.pieces import load_pieces
from patronage.llm.textbatch import blocks

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "a", "Hello world", "  two  spaces ", "tab\tand\nline\r\n", "▁marker ▁▁ x", "naïve façade 😀 日本語",
    "word" * 400, "ab" * 3000, "\u0000\u0001", "é ‮ x", " \n ", "Der Zug fährt nach Köln.", "x" * 20_000,
]


@pytest.fixture(scope="module")
def table():
    return S.check_boundaries(load_pieces(MODEL))


@pytest.fixture(scope="module")
def library(table):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for piece, score in zip(proto.pieces, table.scores):
        piece.score = float(score)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def encoded(table, texts):
    out = []
    for _, data, starts in blocks(pa.array(texts)):
        ids, counts = S.encode_block(table, data, starts)
        ends = np.cumsum(counts)
        out += [ids[e - c : e].tolist() for e, c in zip(ends, counts)]
    return out


def test_equals_the_library(table, library):
    rng = random.Random(3)
    letters = "etaoin shrdlu äöß éè,.;'-\n0123ABC"
    texts = [t for t in TEXTS if "▁" not in t and "\u0000" not in t]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(300)]
    got = encoded(table, texts)
    for text, ids in zip(texts, got):
        want = library.encode(text)
        if ids != want:  # two paths of one score, but for rounding
            score = lambda x: sum(table.scores[i] if i not in set(table.byte_ids.tolist()) else 0 for i in x)
            assert abs(score(ids) - score(want)) < 1e-2 and library.decode(want) == text, text


def test_best_path_by_brute_force(table):
    byte_ids = set(table.byte_ids.tolist())
    by_text = {t: i for i, t in enumerate(table.texts) if t and i not in byte_ids}
    for word in ["the", "thinoner", "schönheit", "a", "ab\tc"]:
        data = (" " + word).encode()
        best = [(-np.inf, [])] * len(data) + [(0.0, [])]
        for i in range(len(data) - 1, -1, -1):
            options = [
                (table.scores[by_text[data[i:j]]] + best[j][0], [by_text[data[i:j]], *best[j][1]])
                for j in range(i + 1, len(data) + 1)
                if data[i:j] in by_text
            ]
            if data[i : i + 1] not in by_text and data[i] < 0x80:
                options.append((table.unknown + best[i + 1][0], [int(table.byte_ids[data[i]]), *best[i + 1][1]]))
            best[i] = max(options, default=(-np.inf, []))
        assert encoded(table, [word])[0] == best[0][1]


def test_round_trip_through_spark(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "y"), (0, "repeated", "z"), (0, "repeated", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    out = S.decode(S.encode(docs, MODEL), MODEL).collect()
    assert len(out) == len(rows) and all(r.text == r.decoded for r in out)
    assert all((r.piece_ids is None) == (r.text is None) for r in out)
    assert [list(r.piece_ids) for r in out if r.text == ""] == [[]]
    trip = S.round_trip(docs, MODEL).collect()
    assert all(r.round_trip for r in trip) and {r.n_pieces for r in trip if r.doc_id is None} == {None}


def test_empty_table_and_foreign_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.round_trip(empty, MODEL).count() == 0
    odd = spark.createDataFrame([([1, 2, -5, 10**6, 266],)], "piece_ids array<int>")
    assert S.decode(odd, MODEL).first().decoded == load_pieces(MODEL).texts[266].decode().removeprefix(" ")
