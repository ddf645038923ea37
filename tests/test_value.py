import math
import random
import tracemalloc
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.operators import clustering
from patronage.operators.sweep import Fits
from patronage.operators.value import boosted, probabilistic, summary, tiers
from patronage.session import written


@pytest.fixture(scope="module")
def purchases(spark):
    rng = random.Random(4)
    rows = []
    for i in range(20):
        for j in range(rng.randint(1, 12)):
            day = pd.Timestamp("2023-01-01") + pd.Timedelta(days=rng.randrange(0, 700, 5), hours=rng.randrange(24))
            rows.append((f"T{i}_{j}", f"C_{i:02d}", day, round(rng.uniform(5, 300), 2)))
    return pd.DataFrame(rows, columns=["transaction_id", "customer_id", "date", "amount"])


def test_library_summary_equals_pandas(spark, purchases):
    daily = purchases.assign(day=purchases.date.dt.normalize()).groupby(["customer_id", "day"]).amount.sum().reset_index()
    last = daily.day.max()
    want = {}
    for cid, part in daily.groupby("customer_id"):
        part = part.sort_values("day")
        if len(part) > 1:
            first = part.day.iloc[0]
            want[cid] = (len(part) - 1, (part.day.iloc[-1] - first).days, (last - first).days, part.amount.iloc[1:].mean())
    got = {r[0]: tuple(r)[1:] for r in summary.purchase_summary(spark.createDataFrame(purchases)).collect()}
    assert set(got) == set(want)
    for cid in want:
        assert got[cid][:3] == want[cid][:3] and got[cid][3] == pytest.approx(want[cid][3])


def test_simple_summary_equals_pandas(spark, purchases):
    last = purchases.date.max()
    groups = purchases.groupby("customer_id")
    want = {
        cid: (len(p) - 1, (p.date.max() - p.date.min()).days, (last - p.date.min()).days, p.amount.mean())
        for cid, p in groups
        if len(p) > 1
    }
    got = {r[0]: tuple(r)[1:] for r in summary.purchase_summary(spark.createDataFrame(purchases), "simple").collect()}
    assert set(got) == set(want)
    for cid in want:
        assert got[cid][:3] == want[cid][:3] and got[cid][3] == pytest.approx(want[cid][3])
    with pytest.raises(ValueError):
        summary.purchase_summary(spark.createDataFrame(purchases), "other")


def test_heuristic_value(spark):
    df = spark.createDataFrame([("a", 3, 10, 90, 20.0), ("b", 1, 0, 0, 5.0)], "customer_id string, frequency long, recency long, T long, monetary_value double")
    got = {r.customer_id: (r.predicted_purchases, r.predicted_clv) for r in summary.heuristic_value(df).collect()}
    assert got["a"] == (pytest.approx(12.0), pytest.approx(240.0)) and got["b"] == (None, None)


@pytest.mark.parametrize("n", [100, 50, 7])
def test_tiers_equal_pandas(spark, n):
    rng = random.Random(n)
    frame = pd.DataFrame({"customer_id": [f"C{i}" for i in range(n)], "predicted_clv": [rng.uniform(0, 1000) for _ in range(n)]})
    got = tiers.value_tiers(written(spark.createDataFrame(frame), "tier-test")).toPandas().set_index("customer_id").clv_tier
    edges = [-np.inf, frame.predicted_clv.quantile(0.33), frame.predicted_clv.quantile(0.66), np.inf]
    want = pd.cut(frame.set_index("customer_id").predicted_clv, edges, labels=list(tiers.TIERS)).astype(str)
    assert got.to_dict() == want.to_dict()
    described = tiers.tier_describe(spark.createDataFrame(frame.assign(clv_tier=want.values))).toPandas().set_index("clv_tier")
    for tier, part in frame.assign(clv_tier=want.values).groupby("clv_tier"):
        d = part.predicted_clv.describe().round(2)
        assert np.allclose(
            described.loc[tier, ["mean", "std", "min", "p25", "p50", "p75", "max"]].astype(float),
            d[["mean", "std", "min", "25%", "50%", "75%", "max"]],
            atol=0.0101,
            equal_nan=True,
        )


def test_coinciding_tier_edges_raise(spark):
    df = spark.createDataFrame([(f"C{i}", 1.0) for i in range(9)], "customer_id string, predicted_clv double")
    with pytest.raises(ValueError):
        tiers.value_tiers(df)


def simulate(n, r, alpha, a, b, horizon, seed):
    """Customers buying and dropping out as BG/NBD assumes."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rate, drop, t, x, last = rng.gamma(r, 1 / alpha), rng.beta(a, b), 0.0, 0, 0.0
        age = float(rng.integers(horizon // 2, horizon))
        while True:
            t += rng.exponential(1 / rate)
            if t > age:
                break
            x, last = x + 1, t
            if rng.random() < drop:
                break
        rows.append((f"C{i}", x, last, age))
    return rows


def test_buying_model_recovers_its_parameters(spark):
    rows = simulate(6000, r=0.9, alpha=20.0, a=0.8, b=2.5, horizon=600, seed=1)
    df = spark.createDataFrame(rows, "customer_id string, frequency long, recency double, T double")
    model = probabilistic.fit_buying(df, penalty=0.0)
    assert model.r == pytest.approx(0.9, rel=0.15) and model.alpha == pytest.approx(20.0, rel=0.2)
    assert model.a / (model.a + model.b) == pytest.approx(0.8 / 3.3, rel=0.15)
    assert model.fit.gradient < 1e-5 and not model.fit.at_boundary
    row = probabilistic.certified(df, model, penalty=0.0).first()
    assert (row.customers, row.converged, row.better_neighbours) == (6000, True, 0)
    off = probabilistic.BuyingModel(model.r * 1.3, model.alpha, model.a, model.b)
    row = probabilistic.certified(df, off, penalty=0.0).first()
    assert not row.converged and row.better_neighbours > 0


def test_a_parameter_that_runs_away_is_flagged(spark):
    """Nobody ever stops buying: the dropout parameters have no finite best value."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(800):
        times = np.cumsum(rng.exponential(1 / rng.gamma(2.0, 1 / 20.0), 400))
        times = times[times <= 300.0]
        if len(times):
            rows.append((f"C{i}", len(times), float(times[-1]), 300.0))
    df = spark.createDataFrame(rows, "customer_id string, frequency long, recency double, T double")
    model = probabilistic.fit_buying(df)
    assert model.fit.at_boundary and model.a < 1e-3
    assert {r.at_boundary for r in model.frame(spark).collect()} == {True}


def numeric_slopes(of, parameters, rows):
    out = []
    for i in range(len(parameters)):
        step = 1e-5 * parameters[i]
        up, down = (np.array(parameters, float) for _ in range(2))
        up[i], down[i] = up[i] + step, down[i] - step
        out.append((of(up, rows)[0] - of(down, rows)[0]) / (2 * step))
    return out


def test_derivatives_equal_differences():
    rng = np.random.default_rng(1)
    x = np.array([0, 0, 1, 2, 7, 40], float)
    t = np.array([0, 0, 3, 9, 20, 30], float)
    rows = {"frequency": x, "recency": t, "T": t + rng.uniform(0.1, 9, 6), "monetary_value": rng.uniform(0.1, 4, 6)}
    for parameters in ([0.8, 2.0, 0.7, 2.5], [3.0, 0.4, 1.6, 0.9]):
        _, slopes = probabilistic.buying_likelihood(np.array(parameters), rows)
        for a, b in zip(slopes, numeric_slopes(probabilistic.buying_likelihood, parameters, rows)):
            assert np.allclose(a, b, rtol=1e-5, atol=1e-7)
    rows = {k: v[2:] for k, v in rows.items()}
    for parameters in ([2.0, 3.0, 1.5], [6.0, 1.2, 0.3]):
        _, slopes = probabilistic.spend_likelihood(np.array(parameters), rows)
        for a, b in zip(slopes, numeric_slopes(probabilistic.spend_likelihood, parameters, rows)):
            assert np.allclose(a, b, rtol=1e-5, atol=1e-7)


def test_spend_model_recovers_its_parameters(spark):
    rng = np.random.default_rng(3)
    p, q, v, rows = 6.0, 4.0, 15.0, []
    for i in range(5000):
        x, scale = int(rng.integers(1, 12)), rng.gamma(q, 1 / v)
        rows.append((f"C{i}", x, float(rng.gamma(p * x, 1 / scale) / x)))
    df = spark.createDataFrame(rows, "customer_id string, frequency long, monetary_value double")
    model = probabilistic.fit_spend(df, penalty=0.0)
    mean = model.p * model.v / (model.q - 1)
    assert mean == pytest.approx(p * v / (q - 1), rel=0.05) and model.q == pytest.approx(q, rel=0.15)


def hyp2f1(a, b, c, z):
    total = term = 1.0
    for n in range(200_000):
        term *= (a + n) * (b + n) / ((c + n) * (n + 1)) * z
        total += term
        if abs(term) < 1e-17 * abs(total):
            break
    return total


@pytest.mark.parametrize("a", [0.3, 0.8, 1.7, 1.0])
@pytest.mark.parametrize("x,t_x,age,t", [(0, 0, 100, 30), (3, 80, 100, 360), (25, 300, 400, 30)])
def test_expected_purchases_equal_the_published_formula(a, x, t_x, age, t):
    r, alpha, b = 1.3, 12.0, 2.2
    model = probabilistic.BuyingModel(r, alpha, a, b)
    got = probabilistic._expected_purchases(model, [x], [t_x], [age], np.array([float(t)]))[0, 0]

    def published(a):
        z = t / (alpha + age + t)
        inner = ((alpha + age) / (alpha + age + t)) ** (r + x) * hyp2f1(r + x, b + x, a + b + x - 1, z)
        top = (a + b + x - 1) / (a - 1) * (1 - inner)
        dead = a / (b + x - 1) * ((alpha + age) / (alpha + t_x)) ** (r + x) if x > 0 else 0.0
        return top / (1 + dead)

    want = published(a) if a != 1.0 else (published(1 - 1e-4) + published(1 + 1e-4)) / 2
    assert got == pytest.approx(want, rel=1e-6)


def test_predicted_value_discounts_monthly_purchases(spark):
    buying, spend = probabilistic.BuyingModel(1.3, 12.0, 0.8, 2.2), probabilistic.SpendModel(6.0, 4.0, 15.0)
    df = spark.createDataFrame([("a", 3, 80, 100, 25.0)], "customer_id string, frequency long, recency long, T long, monetary_value double")
    row = probabilistic.predict_value(df, buying, spend, months=3, discount_rate=0.02).first()
    upto = probabilistic._expected_purchases(buying, [3], [80], [100], np.array([30.0, 60.0, 90.0]))[0]
    money = 6.0 * (15.0 + 3 * 25.0) / (6.0 * 3 + 4.0 - 1)
    monthly = np.diff(np.insert(upto, 0, 0.0))
    assert row.predicted_purchases == pytest.approx(upto[-1])
    assert row.predicted_clv == pytest.approx(sum(m / 1.02 ** (k + 1) for k, m in enumerate(monthly)) * money)


# --- clustering -------------------------------------------------------------


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        centre = (i % 3) * 10.0
        rows.append((f"C{i:03d}", *[float(v) for v in rng.normal(centre, 0.5, 3)], 7.0))
    return written(spark.createDataFrame(rows, "customer_id string, a double, b double, c double, d double"), "blobs")


def test_scaling(blobs):
    frame = clustering.scale(blobs).toPandas()
    assert np.allclose(frame[["a", "b", "c"]].mean(), 0) and np.allclose(frame[["a", "b", "c"]].std(ddof=0), 1)
    assert (frame.d == 0).all()


def test_optimal_k_and_clusters(spark, blobs):
    choice = clustering.find_optimal_k(clustering.scale(blobs), max_clusters=5, starts=2)
    assert choice.k == 3 and set(choice.inertias) == {2, 3, 4, 5}
    first = clustering.fit_clusters(blobs, k=3, starts=2).toPandas().set_index("customer_id").cluster
    again = clustering.fit_clusters(blobs.repartition(7), k=3, starts=2).toPandas().set_index("customer_id").cluster
    assert first.sort_index().equals(again.sort_index())
    assert all(len({first[f"C{i:03d}"] for i in range(120) if i % 3 == g}) == 1 for g in range(3))
    clustered = clustering.fit_clusters(blobs, k=3, starts=2)
    profiles = clustering.cluster_profiles(clustered).collect()
    assert sum(p.size_ if hasattr(p, "size_") else p["size"] for p in profiles) == 120
    assert abs(sum(p.pct_of_total for p in profiles) - 100) < 1
    spots = clustering.pca_projection(clustered).toPandas()
    assert len(spots) == 120 and spots.pca_x.var() > spots.pca_y.var() and abs(spots.pca_x.mean()) < 1e-9


def test_a_fit_is_at_rest(spark, blobs):
    row = clustering.fit_certificate(clustering.fit_clusters(blobs, k=4, starts=3)).first()
    assert (row.points, row.off_nearest, row.clusters) == (120, 0, 4)
    wrong = clustering.fit_clusters(blobs, k=3, starts=2).withColumn(
        "cluster", F.when(F.col("customer_id") == "C000", (F.col("cluster") + 1) % 3).otherwise(F.col("cluster"))
    )
    assert clustering.fit_certificate(written(wrong, "wrong")).first().off_nearest == 1


def test_figures_of_given_labels_equal_brute_force(spark, blobs):
    frame = clustering.scale(blobs).toPandas().sort_values("customer_id")
    x = frame[["a", "b", "c", "d"]].to_numpy()
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    number = np.arange(120)
    labels = {3: number % 3, 5: np.minimum(number % 7, 3), 2: np.where(number == 5, 1, 0)}  # of five one is empty
    column = F.substring("customer_id", 2, 3).cast("int")
    expressions = {3: column % 3, 5: F.least(column % 7, F.lit(3)), 2: (column == 5).cast("int")}
    choice = clustering.choice_for(clustering.scale(blobs), expressions)
    for k, own in labels.items():
        inertia = sum(((x[own == c] - x[own == c].mean(axis=0)) ** 2).sum() for c in np.unique(own))
        values = []
        for i in range(120):
            mates = own == own[i]
            inside = apart[i][mates].sum() / max(mates.sum() - 1, 1)
            outside = min(apart[i][own == c].mean() for c in np.unique(own) if c != own[i])
            values.append(0.0 if mates.sum() == 1 else (outside - inside) / max(inside, outside))
        assert choice.inertias[k] == pytest.approx(inertia) and choice.silhouettes[k] == pytest.approx(np.mean(values))


def test_one_cluster_alone_has_the_least_silhouette(spark, blobs):
    assert clustering.choice_for(clustering.scale(blobs), {2: F.lit(0)}).silhouettes[2] == -1.0


def test_all_fits_share_the_passes(spark, blobs):
    choice = clustering.find_optimal_k(clustering.scale(blobs), max_clusters=6, starts=4)
    assert choice.passes < 60  # 20 fits
    inertias = [choice.inertias[k] for k in sorted(choice.inertias)]
    assert inertias == sorted(inertias, reverse=True)


def test_equal_points_and_more_clusters_than_places(spark):
    rows = written(spark.createDataFrame([(f"C{i}", float(i % 2), 1.0) for i in range(30)], "customer_id string, a double, b double"), "two-places")
    clustered = clustering.fit_clusters(rows, k=4, starts=2)
    assert {r.n for r in clustered.groupBy("a").agg(F.countDistinct("cluster").alias("n")).collect()} == {1}
    assert clustering.find_optimal_k(clustering.scale(rows), max_clusters=4, starts=2).k >= 2


def test_components_equal_the_eigenvectors(spark, blobs):
    scaled = clustering.scale(blobs.drop("d").withColumn("e", F.col("a") * F.col("b")))
    x = scaled.toPandas()[["a", "b", "c", "e"]].to_numpy()
    values, basis = np.linalg.eigh(np.cov(x.T))
    found = clustering.principal_components(scaled.repartition(7))
    assert np.allclose(found.variances, values[::-1][:2]) and found.total_variance == pytest.approx(np.trace(np.cov(x.T)))
    for own, want in zip(found.loadings.T, basis.T[::-1][:2]):
        assert np.allclose(own, want * np.sign(want[np.abs(want).argmax()]))


def test_all_centres_of_a_pass_equal_brute_force():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 2, (500, 4)))  # with equally near centres
    centres = [np.round(rng.normal(0, 2, (k, 4))) for k in (2, 2, 5, 3, 3)]
    fits = Fits(centres)
    number, least = fits.nearest(x)
    added, at = fits.figures(x), 0
    for j, c in enumerate(centres):
        apart = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (number[:, j] - fits.borders[j] == apart.argmin(axis=1)).all() and np.allclose(least[:, j], apart.min(axis=1))
        for i in range(len(c)):
            own = x[apart.argmin(axis=1) == i]
            assert np.allclose(added[at * 4 : at * 4 + 4], own.sum(axis=0)) and added[15 * 4 + at] == len(own)
            at += 1
        assert added[15 * 5 + j] == pytest.approx(apart.min(axis=1).sum())


def test_a_block_holds_the_distances_of_one_group_at_a_time():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (2048, 10))
    fits = Fits([rng.normal(0, 1, (k, 10)) for k in range(2, 11) for _ in range(10)])
    tracemalloc.start()
    fits.figures(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(fits.stacked) * len(x) * 8 / 2


def test_points_spread_evenly_over_tasks(spark):
    """Rows that come in one file, of which a pass would be one task."""
    rows = written(spark.range(40_000).selectExpr("concat('C', id) AS customer_id", "double(id % 7) AS a").coalesce(1), "one-file")
    kept, n, parts = clustering.points(rows)
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    kept.unpersist()
    assert n == 40_000 and parts == 8 and len(sizes) == 8 and max(sizes) < 2 * n / 8


def test_too_few_points_give_two(spark, blobs):
    assert clustering.find_optimal_k(blobs.limit(2)) == clustering.KChoice(2, {}, {})


def test_choice_of_k():
    ks = {2: 100.0, 3: 40.0, 4: 35.0, 5: 31.0}
    assert clustering.choose_k(ks, {2: 0.5, 3: 0.7, 4: 0.7, 5: 0.1}) == 3
    assert clustering.choose_k(ks, {2: 0.1, 3: 0.2, 4: 0.3, 5: 0.9}) == 2
    assert clustering.choose_k({2: 9.0, 3: 1.0}, {2: 0.1, 3: 0.2}) == 3


# --- boosted regression -----------------------------------------------------


def test_boosted_fit(spark):
    rng = np.random.default_rng(6)
    rows = [(f"C{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 10, (400, 2)))]
    df = spark.createDataFrame(rows, "customer_id string, x double, noise double")
    fit = boosted.fit_boosted(df, F.col("x") * 3, folds=2, trees=8, depth=3)
    assert fit.r2 > 0.7 and fit.cv_r2 > 0.7 and fit.mae < 4
    assert fit.importance[0][0] == "x" and math.isclose(sum(w for _, w in fit.importance), 1.0, rel_tol=1e-6)
    again = fit.model.transform(df).select("customer_id", "prediction").toPandas().set_index("customer_id").prediction
    listed = fit.predictions.toPandas().set_index("customer_id")
    assert np.allclose(again.sort_index(), listed.prediction.sort_index())
    held = listed[listed.held_out]
    assert fit.mae == pytest.approx((held.label - held.prediction).abs().mean())
    assert fit.r2 == pytest.approx(1 - ((held.label - held.prediction) ** 2).sum() / ((held.label - held.label.mean()) ** 2).sum())
    assert fit.passes == 8  # the sample holds all rows


def plain_boost(codes, y, trees, depth, rate):
    """Level-wise greedy boosting of one model, node by node over all rows."""
    pred, out = np.full(len(y), y.mean()), []
    for _ in range(trees):
        residual, nodes = y - pred, {0: np.arange(len(y))}
        splits, values = {}, {}
        for node in range(2 ** (depth + 1) - 1):
            rows = nodes.get(node)
            if rows is None:
                continue
            values[node] = residual[rows].mean()
            best = (1e-9 * (1 + residual[rows].sum() ** 2 / len(rows)), None)
            if node < 2**depth - 1 and len(rows) > 1:
                for f in range(codes.shape[1]):
                    for b in np.unique(codes[rows, f])[:-1]:
                        left = codes[rows, f] <= b
                        l, r = residual[rows[left]], residual[rows[~left]]
                        gain = l.sum() ** 2 / len(l) + r.sum() ** 2 / len(r) - residual[rows].sum() ** 2 / len(rows)
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (f, int(b)))
            if best[1]:
                splits[node] = best[1]
                left = codes[rows, best[1][0]] <= best[1][1]
                nodes[2 * node + 1], nodes[2 * node + 2] = rows[left], rows[~left]
            else:
                pred[rows] += rate * values[node]
        out.append(splits)
    return pred, out


@pytest.mark.parametrize("sample", [40_000, 40])
def test_trees_are_those_of_greedy_growth_whatever_the_sample(spark, monkeypatch, sample):
    monkeypatch.setattr(boosted, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(boosted, "KEEP_TREES", 3)
    rng = np.random.default_rng(sample)
    x = np.round(rng.uniform(0, 30, (300, 3)))
    df = spark.createDataFrame([(f"C{i}", *map(float, r)) for i, r in enumerate(x)], "customer_id string, a double, b double, c double")
    features = written(df, "greedy")
    fit = boosted.fit_boosted(features, F.expr("2 * a + IF(b > 12, 25, 0) + c * c / 50"), folds=None, trees=5, depth=3)
    listed = fit.predictions.toPandas().sort_values("customer_id")
    rows = df.toPandas().sort_values("customer_id")
    codes = boosted.codes_of(rows[["a", "b", "c"]].to_numpy(), fit.model.edges)
    train = ~listed.held_out.to_numpy()
    pred, splits = plain_boost(codes[train], listed.label.to_numpy()[train], 5, 3, 0.1)
    assert np.allclose(listed.prediction.to_numpy()[train], pred)
    for tree, want in zip(fit.model.trees, splits):
        assert {int(n): (int(tree.feature[n]), int(tree.bin[n])) for n in np.flatnonzero(tree.feature >= 0)} == want
    assert fit.passes == 5 if sample > 300 else fit.passes > 5


def test_the_driver_gets_splits_and_no_sums(spark, monkeypatch):
    kind, fetched = type(spark.range(1)), []
    real = kind.toArrow

    def noted(self):
        table = real(self)
        fetched.append(table.nbytes)
        return table

    monkeypatch.setattr(kind, "toArrow", noted)
    rng = np.random.default_rng(12)
    rows = [(f"C{i}", *map(float, r)) for i, r in enumerate(rng.uniform(0, 9, (300, 4)))]
    df = written(spark.createDataFrame(rows, "customer_id string, a double, b double, c double, d double"), "few-bytes")
    fit = boosted.fit_boosted(df, F.expr("a * b + c"), folds=2, trees=3, depth=4)
    # 3 models, 31 nodes; the sample has 300 rows of a few dozen bytes. The sums of one pass are 196,608 bytes.
    assert fit.passes == 3 and len(fetched) >= 4 and sum(fetched) < 60_000


def test_a_pass_leaves_no_shuffle_files(spark, monkeypatch):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    def noted(self, *args):
        before = files()
        real(self, *args)
        left.append(len(files() - before))

    real, left = boosted.Booster._measure, []
    monkeypatch.setattr(boosted.Booster, "_measure", noted)
    rng = np.random.default_rng(12)
    rows = [(f"C{i}", *map(float, r)) for i, r in enumerate(rng.uniform(0, 9, (300, 2)))]
    df = written(spark.createDataFrame(rows, "customer_id string, a double, b double"), "few-files")
    boosted.fit_boosted(df, F.expr("a * b"), folds=2, trees=3, depth=4)
    assert left == [0, 0, 0]


def test_folds_are_predicted_by_models_that_have_not_seen_them(spark):
    """Labels that nothing explains: a model that had seen its rows would fit them."""
    rng = np.random.default_rng(9)
    rows = [(f"C{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (300, 2)))]
    df = written(spark.createDataFrame(rows, "customer_id string, x double, y double"), "noise")
    fit = boosted.fit_boosted(df.select("customer_id", "x"), F.sin(F.hash("customer_id")), folds=4, trees=20, depth=4)
    listed = fit.predictions.toPandas()
    seen, unseen = np.corrcoef(listed.label, listed.prediction)[0, 1], np.corrcoef(listed.label, listed.fold_prediction)[0, 1]
    assert seen > 0.5 and abs(unseen) < 0.25 and fit.cv_r2 < 0.1
    per = [1 - ((p.label - p.fold_prediction) ** 2).sum() / ((p.label - p.label.mean()) ** 2).sum() for _, p in listed.groupby("fold")]
    assert fit.cv_r2 == pytest.approx(np.mean(per)) and len(per) == 4


def test_missing_and_constant_features(spark):
    rows = [(f"C{i}", None if i % 5 == 0 else float(i % 7), 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id string, x double, same double")
    fit = boosted.fit_boosted(df, F.coalesce(F.col("x") * 2, F.lit(40.0)), folds=2, trees=60, depth=3, rate=0.2)
    assert fit.r2 > 0.99 and dict(fit.importance)["same"] == 0.0


def test_repeat_customers_without_spend_are_an_error(spark):
    df = spark.createDataFrame([("a", 2, 10, 20, 5.0), ("b", 1, 3, 20, 0.0)], "customer_id string, frequency long, recency long, T long, monetary_value double")
    with pytest.raises(ValueError, match="1 repeat"):
        probabilistic.fit_spend(df)


def test_a_search_that_runs_out_of_steps_is_an_error():
    from patronage.operators.value.fitting import minimise

    class Falling:
        """Descends for ever."""

        def at(self, points):
            return np.array([-float(np.sum(p)) for p in points]), -np.ones((len(points), 2))

    with pytest.raises(ArithmeticError, match="no convergence"):
        minimise(Falling(), [1.0, 1.0], max_steps=5)


def test_a_search_finds_the_bottom_of_a_steep_valley():
    from patronage.operators.value.fitting import minimise

    class Steep:
        """Bends so much that a thousandth of the gradient leads far up the other side."""

        def at(self, points):
            off = np.array([p - [0.3, -0.2] for p in points])
            return 1e4 * (off**2).sum(axis=1), 2e4 * off

    theta, fit = minimise(Steep(), np.exp([0.3 + 1e-7, -0.2]))
    assert fit.gradient < 1e-6 and np.log(theta) == pytest.approx([0.3, -0.2], abs=1e-9)


@pytest.mark.parametrize("of,parameters", [("buying_likelihood", (0.8, 5.0, 0.6, 2.0)), ("spend_likelihood", (2.0, 4.0, 1.5))])
def test_gamma_functions_are_worked_out_once_per_frequency(monkeypatch, of, parameters):
    rng = np.random.default_rng(1)
    rows = {"frequency": rng.integers(1, 6, 4000).astype(float), "recency": rng.uniform(1, 50, 4000)}
    rows |= {"T": rows["recency"] + rng.uniform(0, 50, 4000), "monetary_value": rng.uniform(1, 90, 4000)}
    value, slopes = getattr(probabilistic, of)(np.array(parameters), rows)
    for i in range(0, 4000, 400):  # a row alone is worth the same
        one, one_slopes = getattr(probabilistic, of)(np.array(parameters), {c: rows[c][i : i + 1] for c in ("frequency", "recency", "T", "monetary_value")})
        assert [one[0], *[x[0] for x in one_slopes]] == pytest.approx([value[i], *[x[i] for x in slopes]], rel=1e-12, abs=1e-12)

    worked = []
    for name in ("log_gamma", "digamma"):
        function = getattr(probabilistic, name)
        monkeypatch.setattr(probabilistic, name, lambda z, function=function: worked.append(np.size(z)) or function(z))
    for _ in range(7):
        getattr(probabilistic, of)(np.array(parameters), rows)
    assert sum(worked) <= 7 * 11 * 5


def test_observations_of_a_fit_are_dealt_evenly(spark):
    few_files = spark.range(40_000).selectExpr("id % 50 AS frequency", "id AS T").coalesce(1)
    counts = probabilistic._counted(few_files, ["frequency", "T"])
    try:
        sizes = [r["count"] for r in counts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        counts.unpersist()
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 1.2 * 40_000 / len(sizes)


def test_a_series_that_does_not_settle_is_an_error():
    with pytest.raises(ArithmeticError, match="settle"):
        probabilistic._hyp2f1(2.0, 2.0, np.array([1.0]), np.array([1.0]))


def test_spend_fit_does_not_depend_on_the_currency(spark):
    rng = np.random.default_rng(4)
    nu = rng.gamma(4.0, 1 / 60.0, 3000)
    x = rng.integers(1, 9, 3000)
    mean = rng.gamma(6.0 * x, 1 / nu) / x
    rows = [(f"c{i}", int(k), float(m)) for i, (k, m) in enumerate(zip(x, mean))]
    one = probabilistic.fit_spend(spark.createDataFrame(rows, "customer_id string, frequency long, monetary_value double"))
    cents = [(c, k, 100 * m) for c, k, m in rows]
    other = probabilistic.fit_spend(spark.createDataFrame(cents, "customer_id string, frequency long, monetary_value double"))
    assert one.q > 1 and other.p == pytest.approx(one.p, rel=1e-3) and other.v == pytest.approx(100 * one.v, rel=1e-3)
