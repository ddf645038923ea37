import random
import time

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.functions import text
from patronage.functions.text import similarity


def random_words(n, alphabet="abcde ", longest=14, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def testsimilarity_agrees_with_duckdb():
    a, b = random_words(20_000, seed=1), random_words(20_000, seed=2)
    got = similarity(pd.Series(a), pd.Series(b))
    frame = pd.DataFrame({"i": range(len(a)), "a": a, "b": b})
    want = duckdb.sql("SELECT i, jaro_winkler_similarity(a, b) AS s FROM frame ORDER BY i").df()["s"]
    filled = (frame.a != "") & (frame.b != "")
    assert (got - want)[filled].abs().max() < 1e-9
    assert (got[~filled] == 0).all()


@pytest.mark.parametrize(
    "a,b,score",
    [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("same", "same", 1.0), ("", "", 0.0), ("ab", "", 0.0)],
)
def testsimilarity_known_values(a, b, score):
    assert similarity(pd.Series([a]), pd.Series([b]))[0] == pytest.approx(score, abs=1e-6)


def testsimilarity_of_long_and_short_texts_in_one_batch():
    long = "abcdefghij" * 400
    got = similarity(pd.Series(["abc", long, long]), pd.Series(["abd", long + "x", "abc"]))
    assert got[0] == pytest.approx(0.8222222) and got[1] > 0.99 and 0 < got[2] < 1


def testsimilarity_of_other_scripts():
    got = similarity(pd.Series(["Ödön Kovács", "李小龙"]), pd.Series(["Odon Kovacs", "李小虎"]))
    assert 0.5 < got[0] < 1 and got[1] == pytest.approx((2 / 3 + 2 / 3 + 1) / 3 + 0.2 * (1 - (2 / 3 + 2 / 3 + 1) / 3))


@pytest.mark.parametrize(
    "alphabet,longest", [("ab", 16), ("abcde ", 40), ("abcdefghijklmnopqrstuvwxyz ", 90), ("李小龙虎Öab", 20), ("0123456789", 10)]
)
def test_all_with_all_equals_pair_by_pair(alphabet, longest):
    sides = [random_words(150, alphabet, longest, seed) + ["", "martha", "marhta", "x" * 70] for seed in (7, 8)]
    left, right = (np.array(side, dtype=object) for side in sides)
    got = text.Compared(right).with_all(left)
    for i, one in enumerate(left):
        assert got[i].tolist() == similarity(pd.Series([one] * len(right)), pd.Series(right)).tolist()


def test_all_with_all_hands_long_texts_to_the_comparison_by_pairs(monkeypatch):
    lengths = []
    compare_all = text._compare_all
    monkeypatch.setattr(text, "_compare_all", lambda codes, a, b, places: lengths.append((a, b)) or compare_all(codes, a, b, places))
    left = np.array(["ab" * 100, "ann"], dtype=object)
    got = text.Compared(left[::-1]).with_all(left)
    assert max(max(pair) for pair in lengths) <= 64  # the table of a step grows with the length
    assert got[0, 1] == got[1, 0] == 1.0 and got[0, 0] == got[1, 1] == similarity(pd.Series(left[:1]), pd.Series(left[1:]))[0]


def test_all_with_all_costs_a_small_part_of_pair_by_pair():
    left, right = (np.array([str(10**9 + k * step) for k in range(1000)], dtype=object) for step in (7919, 7907))

    def seconds(run):
        times = []
        for _ in range(3):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        return min(times)

    pairs = [pd.Series(np.repeat(left[:20], 1000)), pd.Series(np.tile(right, 20))]
    # Fifty times the pairs in less than ten times the time.
    assert seconds(lambda: text.Compared(right).with_all(left)) < 10 * seconds(lambda: similarity(*pairs))


def test_ceiling_is_never_below_the_similarity(spark):
    rows = list(zip(random_words(3000, seed=5), random_words(3000, seed=6)))
    df = spark.createDataFrame(rows, "a string, b string")
    below = df.where(text.similarity_ceiling(F.col("a"), F.col("b")) < text.jaro_winkler("a", "b") - 1e-12)
    assert below.count() == 0


def test_normal_forms(spark):
    df = spark.createDataFrame(
        [
            (" TEST @Example.COM\t", "+1-(555)-123-4567", "\n Ann Lee "),
            (None, None, None),
            ("a@b.c", "x", "   "),
        ],
        "email string, phone string, name string",
    )
    name = text.normal_name(F.col("name"))
    rows = df.select(
        text.normal_email(F.col("email")), text.digits(F.col("phone")), name, text.block_letter(name)
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("test@example.com", "15551234567", "ann lee", "A"),
        ("", "", "", None),
        ("a@b.c", "", "", None),
    ]
