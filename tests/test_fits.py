"""Fits of many passes against brute force: optimality, best of starts, gradients, and the same result under any partitioning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnstone.operators import kernel, kmeans, logistic, network
from turnstone.operators import models as ops
from turnstone.operators import passes as runs


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.4, (50, 2)) for c in (0, 2, 4, 6, 8)])
    pdf = pd.DataFrame(x, columns=["u", "v"]).assign(g=np.where(np.arange(250) % 2 == 0, "a", "b"))
    return pdf, spark.createDataFrame(pdf)


def test_sums_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(runs, "FAN_IN", 3)
    df = spark.range(1000).repartition(13).select(F.col("id").alias("x"), F.when(F.col("id") % 2 == 0, 1).alias("y"))
    with runs.Blocks(df, ["x", "y"], rows=17) as data:
        assert data.rows == 1000 and data.tasks == 13
        total = data.total(lambda b, s: np.array([b[:, 0].sum() * s, b[:, 1].sum()]), 2.0, (2,))
        least = data.total(lambda b, s: b.min(0), None, (2,), np.minimum, np.inf)
    assert total.tolist() == [999000.0, 500.0] and least.tolist() == [0.0, 0.0]
    with runs.Blocks(df.where("x < 0"), ["x"]) as data:
        assert data.rows == 0 and data.total(lambda b, s: b.sum(0), None, (1,)).tolist() == [0.0]


def test_few_rows_of_many_tasks_take_few(spark):
    df = spark.range(100).repartition(40).select(F.col("id").alias("x"))
    with runs.Blocks(df, ["x"], rows=30) as data:
        assert data.rows == 100 and data.tasks == 4
        assert data.data.agg(F.max("n")).first()[0] <= 30
        assert data.total(lambda b, s: b.sum(0), None, (1,)).tolist() == [4950.0]
    assert not data.data.storageLevel.useMemory
    with runs.Blocks(df.where("x < 20"), ["x"], rows=30) as data:
        assert data.tasks == 1 and data.data.count() == 1


def test_many_starts_beat_one_and_end_at_means(points):
    pdf, df = points
    best = kmeans.fit(df, ["u", "v"], 5, starts=40, seed=3)
    assert best.of_starts.shape == (1, 40) and best.inertia[""] == best.of_starts.min()
    placed = kmeans.place(df, ["u", "v"], best).toPandas()
    x, centres = placed[["u", "v"]].to_numpy(), best.centres[""]
    apart = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (apart.argmin(1) == placed.cluster).all() and apart.min(1).sum() == pytest.approx(best.inertia[""])
    for c in range(5):
        np.testing.assert_allclose(x[placed.cluster == c].mean(0), centres[c], atol=1e-6)
    again = kmeans.fit(df.repartition(7), ["u", "v"], 5, starts=40, seed=3)
    np.testing.assert_allclose(again.of_starts, best.of_starts, rtol=1e-9)
    got = ops.inertia(kmeans.place(df, ["u", "v"], best), ["u", "v"], "cluster").first()
    assert (got.n, got.clusters, got.strays) == (250, 5, 0) and got.inertia == pytest.approx(best.inertia[""])


def test_groups_share_passes_and_equal_fits_of_their_own(points):
    _, df = points
    both = kmeans.fit(df, ["u", "v"], 3, "g", ["a", "b"], starts=5, seed=1)
    for name in "ab":
        own = kmeans.fit(df.where(F.col("g") == name), ["u", "v"], 3, starts=5, seed=1)
        np.testing.assert_allclose(np.sort(own.centres[""], axis=0), np.sort(both.centres[name], axis=0), atol=1e-6)
    assert kmeans.place(df.withColumn("g", F.lit("c")), ["u", "v"], both, "g").where("cluster IS NOT NULL").count() == 0


def test_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,)], "u double")
    fitted = kmeans.fit(df, ["u"], 5, starts=4)
    assert fitted.inertia[""] == 0 and kmeans.place(df, ["u"], fitted).where("cluster IS NULL").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.7, size=400) > 0.8).astype(int)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y, m=rng.integers(0, 3, 400))
    return pdf, spark.createDataFrame(pdf)


def objective(p, x, y, weight, c, share):
    z = x @ p[:-1] + p[-1]
    return c * (weight * (np.logaddexp(0, z) - y * z)).sum() + (1 - share) / 2 * (p[:-1] ** 2).sum() + share * np.abs(p[:-1]).sum()


def test_side_by_side_fits_are_optimal(labelled):
    pdf, df = labelled
    fits = [logistic.Fit(m, c, p, w) for m in ((0, 1, 2), (0, 2)) for c in (0.05, 1, 100) for p in logistic.PENALTIES for w in (None, "balanced")]
    with logistic.Trainer(df.repartition(5), list("abcd"), "y", F.col("m"), 3) as trainer:
        solved, made = trainer.fit(fits)
        right = trainer.accuracy(solved, made, [1] * len(fits))
    assert solved.passes <= 30 and solved.gap.max() <= 1e-6 and ((right >= 0.6) & (right <= 1)).all()
    rng = np.random.default_rng(0)
    for one, p in zip(fits, solved.parameters):
        own = pdf[pdf.m.isin(one.members)]
        x, y = own[list("abcd")].to_numpy(), own.y.to_numpy()
        share = np.bincount(y, minlength=2)
        weight = (len(y) / (2 * share))[y] if one.class_weight else np.ones(len(y))
        least = objective(p, x, y, weight, one.c, logistic.PENALTIES[one.penalty])
        for _ in range(20):
            assert objective(p + rng.normal(scale=1e-3, size=5), x, y, weight, one.c, logistic.PENALTIES[one.penalty]) >= least - 1e-9
    assert any((p[:-1] == 0).any() for one, p in zip(fits, solved.parameters) if one.penalty == "l1")


def test_left_out_features_and_one_class(spark, labelled):
    _, df = labelled
    with logistic.Trainer(df, list("abcd"), "y", F.lit(0), 1) as trainer:
        solved, _ = trainer.fit([logistic.Fit((0,), scales=(1.0, 0.0, 2.0, 1.0))])
        assert solved.parameters[0][1] == 0 and solved.gap[0] <= 1e-6
    out = ops.logistic_scores(df.where("y = 1"), df, list("abcd"), "y").toPandas()
    assert len(out) == 400 and (out.probability > 0.9).all()
    got = ops.first_order(df.withColumn("g", F.lit("g")), "g", {"g": [1.0] * 4}, list("abcd"), "y").first()
    assert got.n == 400 and abs(got.excess) < 1e-4 and got.pull > 0  # features are not standardised by the check alone


def exact_kernel_fit(x, y, c, band, gamma):
    """Support vector regression by projected gradient steps on the dual, with the intercept from free rows."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    n = len(y)
    beta = np.zeros(n)
    step = 1 / np.linalg.eigvalsh(k)[-1]
    for _ in range(20000):
        wish = beta - step * (k @ beta - y)
        wish = np.sign(wish) * np.maximum(np.abs(wish) - step * band, 0)
        low, high = -1e3, 1e3  # the shift that keeps the sum at nothing within the box
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if np.clip(wish - mid, -c, c).sum() > 0 else (low, mid)
        beta = np.clip(wish - low, -c, c)
    free = (np.abs(beta) > 1e-3) & (np.abs(beta) < c - 1e-3)
    rest = y - k @ beta - band * np.sign(beta)
    return lambda q: np.exp(-gamma * ((q[:, None] - x[None]) ** 2).sum(2)) @ beta + rest[free].mean()


def test_kernel_regression_is_near_the_exact_one(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-2, 2, (120, 1))
    y = np.sin(2 * x[:, 0]) + rng.normal(scale=0.1, size=120)
    exact = exact_kernel_fit(x, y, 1.0, 0.1, 1.0)(x)
    pdf = pd.DataFrame({"x": x[:, 0], "y": y, "g": np.where(np.arange(120) % 2 == 0, "e", "o")})
    df = spark.createDataFrame(pdf)
    model = kernel.fit(df.withColumn("one", F.lit("one")), ["x"], "y", "one", ["one"], waves=512)
    got = kernel.predict(model, df.withColumn("one", F.lit("one")), ["x"], "one").orderBy("x").toPandas()
    assert np.abs(got.predicted.to_numpy() - exact[np.argsort(x[:, 0])]).mean() < 0.05 and model.solved.gap[0] < 1e-4
    both = kernel.fit(df, ["x"], "y", "g", ["e", "o"])
    alone = kernel.fit(df.where("g = 'o'").repartition(6), ["x"], "y", "g", ["o"])
    np.testing.assert_allclose(both.solved.parameters[1], alone.solved.parameters[0], atol=1e-5)
    assert kernel.predict(both, df.withColumn("g", F.lit("none")), ["x"], "g").where("predicted IS NOT NULL").count() == 0


def test_polynomial_features_are_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6, 3))
    phi = kernel.Kernel("poly", 0.3, 3).features(x)
    np.testing.assert_allclose(phi @ phi.T, (0.3 * x @ x.T) ** 3)
    with pytest.raises(ValueError):
        kernel.Kernel("other", 1.0, 2).features(x)


def test_back_propagation_equals_differences():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(40, 3)), rng.normal(size=40)
    p = network.start(3, (5, 4)) + 0.1 * rng.normal(size=len(network.start(3, (5, 4))))
    _, gradient = network.loss_and_gradient(p, x, y, (5, 4))
    value = lambda q: network.loss_and_gradient(q, x, y, (5, 4))[0]
    differences = np.array([(value(p + 1e-6 * e) - value(p - 1e-6 * e)) / 2e-6 for e in np.eye(len(p))])
    np.testing.assert_allclose(gradient, differences, atol=1e-6)


def test_network_learns_and_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(-2, 2, (1500, 2))
    pdf = pd.DataFrame(x, columns=["u", "v"]).assign(y=np.sin(2 * x[:, 0]) * x[:, 1], new=np.arange(1500) % 5 == 0)
    df = spark.createDataFrame(pdf)
    models = [network.fit(df.where("NOT new").repartition(n), ["u", "v"], "y", (16,), passes=60) for n in (2, 7)]
    outs = [network.predict(m, df.where("new"), ["u", "v"]).orderBy("u").toPandas() for m in models]
    error = ((outs[0].predicted - outs[0].y) ** 2).mean()
    assert error < 0.4 * outs[0].y.var()
    assert abs(((outs[1].predicted - outs[1].y) ** 2).mean() - error) < 0.2 * outs[0].y.var()
    few = [network.fit(df.repartition(n), ["u", "v"], "y", (16,), passes=6).parameters for n in (2, 7)]
    np.testing.assert_allclose(few[0], few[1], atol=1e-6)
    null = spark.createDataFrame([(None, 1.0)], "u double, v double")
    assert network.predict(models[0], null, ["u", "v"]).first().predicted is not None
