"""Removal of repeated passages next to a comparison of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from patronage.llm import substrings
from patronage.llm.substrings import ANCHOR, COVER, PERIOD, WINDOW

SCHEMA = "doc_id long, text string, lang string"


def plain(rows):
    """``doc_id, n_words, n_removed, digest, spans, kept`` of rows with different ids."""
    seen, out = set(), {}
    for at, (doc, text, *_) in sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0)):
        w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
        gone = [False] * len(w)
        for i in range(len(w) - WINDOW + 1):
            window = tuple(w[i : i + WINDOW])
            if window in seen:
                gone[i : i + WINDOW] = [True] * WINDOW
            seen.add(window)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        edges = np.flatnonzero(np.diff([0, *map(int, gone), 0]))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        out[at] = (doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), spans, kept)
    return sorted(out.values(), key=repr)


def found(docs, **options):
    rows = substrings.remove_repeats(docs, texts=True, **options).collect()
    return sorted(
        ((r[0], r.n_words, r.n_removed, r.kept_sha256, [tuple(s) for s in r.removed], r.kept_text) for r in rows), key=repr
    )


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    assert ANCHOR + PERIOD - 1 == WINDOW and ANCHOR >= PERIOD


def test_anchor_places():
    for n in (0, 13, 19, 20, 21, 33, 34, 35, 100):
        places, counts = substrings.anchor_places(np.array([n, 5, n]))
        want = [q for q in range(n - ANCHOR + 1) if q % PERIOD in COVER] if n >= WINDOW else []
        assert counts.tolist() == [len(want), 0, len(want)] and places.tolist() == want * 2


@pytest.mark.parametrize("seed", range(4))
def test_equals_all_windows(spark, seed):
    """Texts put together from passages of all lengths, few words, so that windows repeat in every alignment."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3 if seed == 0 else 400)]
    passages = [[rng.choice(words) for _ in range(rng.choice([5, 19, 20, 21, 27, 60, 200]))] for _ in range(12)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 40))]
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(text), "en"))
    rows += [(1000 + i, rows[i % 7][1], "en") for i in range(60)]
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(6)) == plain(rows)


def test_chains_of_edits_and_other_continuations(spark):
    """The earliest occurrence of an anchor goes on otherwise than the one that a window repeats."""
    base = [f"b{i}" for i in range(120)]
    rows = [(1, " ".join(base[30:50]), "x")]
    for k in range(2, 40):
        text = list(base)
        text[(7 * k) % 120] = f"edit{k % 5}"
        rows.append((k, " ".join(["pre"] * (k % 8) + text), "x"))
    rows.append((50, " ".join(["loop"] * 300), "x"))
    rows.append((51, " ".join(["loop"] * 45 + base[:19]), "x"))
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_odd_rows(spark):
    long = " ".join(f"n{i}" for i in range(30_000))
    rows = [
        (1, None, None), (2, "", None), (3, " \t\n\x0b", None), (4, "one two", None), (5, long, None), (6, "Ü " + long, None),
        (7, "a " * 19, None), (8, "a " * 20, None), (9, "A " * 20, None), (10, "a b " * 25, None), (None, "a " * 25, None),
    ]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_rows_that_repeat_an_id(spark):
    text, other = " ".join(f"t{i}" for i in range(40)), " ".join(f"u{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "a"), (5, other, "a"), (3, None, "a"), (3, None, "a"), (None, text, "a")]
    out = found(spark.createDataFrame(rows, SCHEMA))
    assert [(r[0], r[1], r[2]) for r in out] == [(3, 0, 0), (3, 0, 0), (5, 40, 0), (5, 40, 0), (5, 40, 40), (None, 40, 40)]


def test_no_rows_and_clashing_names(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = spark.createDataFrame([(1, text, "a"), (2, text + " end", "a")], SCHEMA)
    clash = rows.selectExpr("*", "1 AS n_words", "2 AS k1", "'x' AS doc", "3 AS row", "'y' AS body", "4 AS hits", "5 AS removed")
    assert found(clash) == found(rows) == plain([(1, text), (2, text + " end")])
    assert found(rows.where("doc_id > 9")) == []
    renamed = rows.withColumnsRenamed({"doc_id": "doc", "text": "body"})
    assert found(renamed, doc_id="doc", text="body") == found(rows)


def test_without_texts(spark):
    rows = spark.createDataFrame([(1, "a b " * 30, "a")], SCHEMA)
    out = substrings.remove_repeats(rows)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"] and out.count() == 1
