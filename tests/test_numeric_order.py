import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.functions.numeric import half_even, log_gamma, whole_days
from patronage.functions import order
from patronage.functions.order import group_quantiles, order_statistics, quantiles


def test_half_even_rounds_as_numpy(spark):
    values = [0.125, 0.375, 2.675, -0.125, 1e9 + 0.005, 33.349999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(half_even(F.col("v"), 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in values]


def test_whole_days_round_down(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-02 00:00:00' AS a, timestamp'2024-01-02 10:00:00' AS b, date'2023-12-30' AS c"
    )
    row = df.select(
        whole_days(F.col("a"), F.col("b")), whole_days(F.col("b"), F.col("a")), whole_days(F.col("b"), F.col("c"))
    ).first()
    assert tuple(row) == (-1, 0, 3)


def test_log_gamma():
    z = np.array([1e-6, 0.1, 0.5, 1.0, 2.5, 7.9, 40.0, 1234.5, 1e6])
    want = np.array([math.lgamma(v) for v in z])
    assert np.allclose(log_gamma(z), want, rtol=1e-12, atol=1e-11)


def test_order_statistics_with_a_hot_value(spark):
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 2, 3, 50]), f"id{i:05d}") for i in range(3001)]
    df = spark.createDataFrame(rows, "v int, id string").repartition(5)
    ordered = sorted(rows)
    ranks = [1, 2, 700, 1500, 3000, 3001]
    got = order_statistics(df, ["v", "id"], ranks)
    assert {r: tuple(got[r]["v" if k == 0 else "id"] for k in (0, 1)) for r in ranks} == {
        r: ordered[r - 1] for r in ranks
    }
    with pytest.raises(ValueError):
        order_statistics(df, ["v", "id"], [3002])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_quantiles_as_pandas(spark, n):
    rng = random.Random(n)
    frame = pd.DataFrame({"v": [rng.gauss(0, 100) for _ in range(n)], "id": range(n)})
    qs = [0.0, 0.1, 0.33, 0.5, 0.66, 1.0]
    got = quantiles(spark.createDataFrame(frame), "v", "id", qs)
    assert np.allclose(got, frame.v.quantile(qs), rtol=1e-12)


def test_group_quantiles_as_pandas(spark):
    rng = random.Random(11)
    frame = pd.DataFrame({"g": [rng.choice("abc") for _ in range(400)], "v": [rng.random() for _ in range(400)]})
    frame["id"] = range(400)
    got = group_quantiles(spark.createDataFrame(frame), "g", "v", "id", (0.25, 0.5, 0.75))
    for g, part in frame.groupby("g"):
        assert np.allclose(got[g], part.v.quantile([0.25, 0.5, 0.75]))


def test_only_the_brackets_are_sorted(spark, monkeypatch):
    sizes = []
    plain = order._sorted_places
    monkeypatch.setattr(order, "_sorted_places", lambda rows, *a: sizes.append(rows.count()) or plain(rows, *a))
    monkeypatch.setattr(order, "SKETCH_ACCURACY", 500)
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1) if i % 3 else 0.25, f"id{i:05d}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "v double, id string").repartition(7)
    ranks = [1, 4000, 10_000, 15_000, 20_000]
    got = order_statistics(df, ["v", "id"], ranks)
    ordered = sorted(rows)
    assert {r: (got[r].v, got[r].id) for r in ranks} == {r: ordered[r - 1] for r in ranks}
    assert sizes[0] < 8_000 and sum(v == 0.25 for v, _ in rows) > 6_000  # the hot value lies in one bracket


def test_text_and_negative_ranks(spark):
    df = spark.createDataFrame([(c, i) for i, c in enumerate("bdac")], "v string, id int")
    assert {r: row.v for r, row in order_statistics(df, ["v", "id"], [1, 3]).items()} == {1: "a", 3: "c"}
    with pytest.raises(ValueError):
        order_statistics(df.select(F.col("id").alias("v"), "id"), ["v", "id"], [0])
