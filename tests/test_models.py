"""Exact parts against brute force; fitted parts by range, shape and repeatability."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnstone.operators import models as ops
from turnstone.operators import neighbours
from turnstone.plans import models as plans
from turnstone.sources.tables import Tables


def brute(points, queries, k):
    out = {}
    for q in {tuple(r) for r in queries}:
        d = np.sqrt(((points - np.array(q)) ** 2).sum(axis=1))
        kth = np.sort(d)[min(k, len(d)) - 1]
        out[q] = sorted(np.round(d[d <= kth + 1e-12], 9))
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_nearest_on_crowded_points(spark, k):
    rng = np.random.default_rng(11)
    crowd = rng.normal(0, 0.001, (150, 2))          # half of all points in one spot
    copies = np.repeat([[5.0, 5.0]], 60, axis=0)    # a group of copies
    spread = rng.uniform(-10, 10, (60, 2))
    points = np.round(np.vstack([crowd, copies, spread, [[500.0, 500.0]]]), 6)
    queries = np.vstack([points[::9], [[100.0, -40.0]]])
    p = spark.createDataFrame(pd.DataFrame(points, columns=["x", "y"]))
    q = spark.createDataFrame(pd.DataFrame(queries, columns=["x", "y"])).distinct()
    near = neighbours.nearest(neighbours.distinct_vectors(p, ["x", "y"]), q, ["x", "y"], k).toPandas()
    want = brute(points, queries, k)
    for key, rows in near.groupby(["q_x", "q_y"]):
        got = sorted(np.round(np.repeat(rows["distance"], rows["n"]), 9))
        assert got == want.pop(tuple(float(v) for v in key))
    assert not want


def test_fewer_points_than_k_returns_all(spark):
    p = spark.createDataFrame([(0.0,), (9.0,)], "x double")
    near = neighbours.nearest(neighbours.distinct_vectors(p, ["x"]), p.limit(1), ["x"], 5)
    assert near.count() == 2


def test_pairs_of_a_round_are_joined_once(spark, monkeypatch):
    joins, cut = [], neighbours.cut_lineage

    def noted(df):
        if "distance" in df.columns:
            joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join Inner"))
        return cut(df)

    monkeypatch.setattr(neighbours, "cut_lineage", noted)
    p = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (2.0,), (2.0,), (40.0,)], "x double")
    near = neighbours.nearest(neighbours.distinct_vectors(p, ["x"]), p.distinct(), ["x"], 3)
    got = {(r["q_x"], r["x"]): (r["n"], r["distance"]) for r in near.collect()}
    assert got == {(q, x): ({0.0: 2, 1.0: 1, 2.0: 2, 40.0: 1}[x], abs(q - x)) for q, x in [
        (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (40.0, 40.0), (40.0, 2.0)]}
    assert set(joins) == {1}


def test_knn_exact_matches_outvote(spark):
    train = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "b"), (1, "b"), (9, "c")], "x int, c string")
    got = {r["x"]: (r["predicted"], round(r["probability"], 4)) for r in neighbours.knn_vote(train, spark.createDataFrame([(0,), (5,)], "x int"), ["x"], "c", 5).collect()}
    assert got[0] == ("a", 0.6667)
    # from 5 the four-distant 1s and 9 tie and the zeros complete the five nearest
    assert got[5][0] == "b"


def test_oversampling_balances_and_stays_between_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(x), float(y), int(i >= 40)) for i, (x, y) in enumerate(rng.uniform(0, 1, (140, 2)))]
    df = spark.createDataFrame(rows, "id long, x double, y double, label int")
    out = neighbours.oversample_minority(df, "id", ["x", "y"], "label", 0).toPandas()
    assert out.groupby("label").size().to_dict() == {0: 100, 1: 100}
    made = out[out.synthetic]
    assert len(made) == 60 and made["x"].between(0, 1).all() and made["y"].between(0, 1).all()
    again = neighbours.oversample_minority(df.repartition(3), "id", ["x", "y"], "label", 0).toPandas()
    key = ["x", "y", "label"]
    pd.testing.assert_frame_equal(out[key].sort_values(key).reset_index(drop=True), again[key].sort_values(key).reset_index(drop=True))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    n = 400
    x = rng.normal(0, 1, (n, 3))
    y = (x[:, 0] * 2 - x[:, 1] + rng.normal(0, 0.3, n) > 0).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=np.arange(n))
    return pdf, spark.createDataFrame(pdf)


def test_auc_and_report_match_brute_force(labelled):
    pdf, df = labelled
    scored = df.withColumn("s", F.round("a", 1)).withColumn("p", (F.col("a") > 0).cast("int"))
    got = ops.roc_auc(scored, "y", "s", F.floor("s")).first()["auc"]
    s = np.array([r["s"] for r in scored.orderBy("id").collect()])
    pos, neg = s[pdf.y == 1][:, None], s[pdf.y == 0][None, :]
    assert got == pytest.approx(((pos > neg).mean() + 0.5 * (pos == neg).mean()))
    report = {r["class"]: r for r in ops.classification_report(scored, "y", "p").collect()}
    p = (pdf.a > 0).astype(int)
    assert report[1]["precision"] == pytest.approx(pdf.y[p == 1].mean())
    assert report[1]["recall"] == pytest.approx(p[pdf.y == 1].mean())


def test_logistic_scores_and_odds(labelled):
    pdf, df = labelled
    out = ops.logistic_scores(df, df, ["a", "b", "c"], "y").toPandas()
    assert out["probability"].between(0, 1).all()
    assert (out["probability"] > 0.5).astype(int).eq(out["y"]).mean() > 0.9
    np.testing.assert_allclose(out.sort_values("id")["a"], pdf["a"])
    odds = {r["feature"]: r["odds_ratio"] for r in ops.coefficient_table(df, ["a", "b", "c"], "y").collect()}
    assert odds["a"] > 1 > odds["b"]


def test_elimination_keeps_the_useful_feature_longest(labelled):
    _, df = labelled
    rows = ops.eliminate_features(df, ["a", "b", "c"], "y", folds=2).orderBy("n_features").collect()
    assert [r["n_features"] for r in rows] == [1, 2, 3]
    assert rows[2]["dropped"] == "c" and rows[0]["kept"] == "a"


def test_clusters_are_repeatable_and_ranked(spark):
    rows = [("s", float(v), float(v)) for base in (0, 100, 200) for v in range(base, base + 10)]
    df = spark.createDataFrame(rows, "g string, x double, worth double")
    got = ops.ranked_clusters(df, ["s"], "g", ["x"], "worth", 3)
    assert {(int(r["x"] // 100), r["cluster"]) for r in got.collect()} == {(0, 1), (1, 2), (2, 3)}


def test_polynomial_recovers_a_polynomial(spark):
    df = spark.createDataFrame([(x / 10.0, (x / 10.0) ** 3) for x in range(-20, 21)], "x double, y double")
    out = ops.polynomial_regression(df, df, ["x"], "y").toPandas()
    assert np.abs(out["predicted"] - out["y"]).max() < 0.05


def test_rows_with_null_features_are_scored(spark):
    rows = [(i, float(i % 7) if i % 5 else None, float(i % 3), int(i % 7 > 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    out = ops.logistic_scores(df, df, ["a", "b"], "y").toPandas()
    assert len(out) == 60 and out.probability.between(0, 1).all() and out.a.isna().sum() == 12
    whole = ops.polynomial_regression(df, df.select("id", "a", "b"), ["a", "b"], "y", degree=2).toPandas()
    assert len(whole) == 60 and whole.predicted.notna().all()
    placed = ops.clusters(df, ["a", "b"], 3).toPandas()
    assert len(placed) == 60 and set(placed.cluster) <= {0, 1, 2}


def test_a_feature_without_values_counts_as_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, a double")
    assert ops.means_of(df, ["a"]) == {"a": 0.0}
    assert [r.x[0] for r in ops.vectors(df, ["a"], "x").collect()] == [0.0, 0.0]


def test_renewal_weights_go_by_feature_name():
    from turnstone.functions.fixed_values import FEATURE_WEIGHTS
    from turnstone.plans.models import RENEWAL_FEATURES

    full = dict(zip(RENEWAL_FEATURES, [FEATURE_WEIGHTS["Full"].get(f, 1) for f in RENEWAL_FEATURES]))
    assert full == {"is_local": 1, "tenure": 1, "paid_show_rate": 2, "show_rate": 2, "self_show_rate": 1, "num_games": 1,
                    "gross_revenue_agg": 1, "level_num": 1, "renewal_likelihood_survey": 2}
    assert FEATURE_WEIGHTS["Premier"]["paid_show_rate"] == 1.5


def test_forest_of_no_training_rows_gives_even_shares(frame):
    rows = frame([("a", 1.0, "win"), ("b", 2.0, "loss"), ("c", None, "win")], "k string, x double, label string")
    out = ops.forest_classes(rows.where("x > 5"), rows, ["x"], "label", ["loss", "win"], trees=3)
    assert out.columns == ["k", "x", "label", "predicted", "p_loss", "p_win"]
    assert sorted((r.k, r.predicted, r.p_loss, r.p_win) for r in out.collect()) == [(k, "loss", 0.5, 0.5) for k in "abc"]
    none = rows.where("x > 5")
    assert ops.forest_classes(none, none, ["x"], "label", ["loss", "win"], trees=3).count() == 0
    lost = rows.where("label = 'loss'")
    assert [(r.p_loss, r.p_win) for r in ops.forest_classes(lost, lost, ["x"], "label", ["loss", "win"], trees=3).collect()] == [(1.0, 0.0)]


def boosted_rows(spark):
    g, s = F.when(F.col("id") % 50 != 0, (F.rand(3) * 40).cast("int")), F.rand(4) * 100
    rows = spark.range(1200).select("id", g.alias("g"), s.alias("s")).withColumn("y", ((F.coalesce("g", F.lit(7)) + F.col("s") / 3 + F.rand(5) * 30) > 55).cast("int"))
    return rows.localCheckpoint()


def test_boosted_cells_give_the_fit_of_the_rows(spark, monkeypatch):
    rows = boosted_rows(spark)
    train, features = rows.where("id < 1000"), ["g", "s"]
    counts = train.groupBy().pivot("y", [0, 1]).count().first()
    means = ops.means_of(train, features)
    data = ops.vectors(train.withColumn("w", F.when(F.col("y") == 1, counts[0] / counts[1]).otherwise(1.0)), features, "x", means)
    model = ops.GBTClassifier(featuresCol="x", labelCol="y", weightCol="w", maxIter=5, maxDepth=4, stepSize=0.1, seed=ops.SEED).fit(data)
    plain = model.transform(ops.vectors(rows, features, "x", means)).select("id", ops.vector_to_array("probability")[1].alias("p"))
    fitted = []
    monkeypatch.setattr(ops.GBTClassifier, "fit", lambda self, df, fit=ops.GBTClassifier.fit: fitted.append(df.count()) or fit(self, df))
    out = ops.boosted_scores(train.unionByName(train), rows, features, "y", trees=5)
    assert out.join(plain, "id").agg(F.max(F.abs(F.col("probability") - F.col("p"))), F.count("*")).first()[:] == (pytest.approx(0, abs=1e-12), 1200)
    assert fitted[0] < 1000  # of 2,000 rows


def test_borders_of_many_values_are_even(spark):
    rows = spark.range(5000).select(F.col("id").cast("double").alias("v"), F.lit(1.0).alias("w"))
    exact, stepped = ops.bin_borders(rows, "v", "w", steps=10000), ops.bin_borders(rows, "v", "w", steps=500)
    assert len(exact) == len(stepped) == 31 and max(abs(a - b) for a, b in zip(exact, stepped)) <= 10
    assert ops.bin_borders(rows.where("v < 3"), "v", "w") == [0.5, 1.5] and ops.bin_borders(rows.where("v < 0"), "v", "w") == []


@pytest.mark.parametrize("shared", [False, True])
def test_classes_are_evened_with_an_empty_document(spark, tmp_path, shared):
    """Also where keys repeat in both tables; texts are read once."""
    texts = [" ".join(["word"] * (i % 7 + 1)) + "s" * i for i in range(30)] + [""]
    rows = [(i, text, len(text)) for i, text in enumerate(texts)] * (2 if shared else 1)
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 3 > 0), 0) for i in range(31)] * (2 if shared else 1)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    t = Tables(spark, str(tmp_path))
    out = plans.oversample(t)
    assert not out.inputFiles()
    times = 4 if shared else 1
    assert {(r.quality, r.synthetic): r.n for r in plans.even_classes(t).collect()} == {(0, False): 11 * times, (1, False): 20 * times, (0, True): 9 * times}
    got = {(round(r["size"], 9), round(r["density"], 9)) for r in out.where("NOT synthetic").collect()}
    assert got == {(round(math.log1p(len(x)), 9), round((x.count(" ") + 1) / len(x), 9) if x else 0.0) for x in texts}
    assert out.where("size IS NULL OR density IS NULL").isEmpty()
