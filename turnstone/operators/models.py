"""Models and their evaluation: trees and linear models by Spark ML, the others by passes over packed blocks.

Training runs on the executors; only coefficients, metrics and class lists reach
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, Bucketizer, MinMaxScaler, PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.scalars import clamp, log_or_zero, ratio
from turnstone.operators import kernel, kmeans, logistic, network
from turnstone.operators.sampling import keyed_random
from turnstone.operators.scan import counted_values
from turnstone.session import cut_lineage

SEED = 1993


@contextmanager
def held(df: DataFrame):
    """Keep training rows for the passes of one fit; lost blocks are recomputed."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def concurrently(fit: Callable, items: Sequence) -> list:
    """Independent fits over a short stated list, their jobs submitted side by side."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return list(pool.map(fit, items))


def means_of(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Means of the training rows; 0 for a feature without any value."""
    found = train.agg(F.struct(*[F.avg(f).alias(f) for f in features])).first()[0]
    return {f: float(found[f] or 0.0) for f in features}


def vectors(df: DataFrame, features: Sequence[str], name: str = "features", fill: Mapping[str, float] | None = None) -> DataFrame:
    """A vector of the features for every row.  A null feature counts as ``fill``, or as 0, the mean of standardised ones."""
    fill = fill or dict.fromkeys(features, 0.0)
    ready = df.withColumns({f"_f_{f}": F.coalesce(F.col(f).cast("double"), F.lit(fill[f])) for f in features})
    names = [f"_f_{f}" for f in features]
    return VectorAssembler(inputCols=names, outputCol=name).transform(ready).drop(*names)


def standardise(train: DataFrame, rows: DataFrame, features: Sequence[str], weights: Sequence[float] | None = None) -> DataFrame:
    """Features of ``rows`` by the mean and population deviation of ``train``, times their weights."""
    stats = train.agg(F.struct(
        *[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"d_{f}") for f in features])).first()[0]
    weights = list(weights or [1.0] * len(features))
    return rows.withColumns({
        f: (F.col(f) - F.lit(stats[f"m_{f}"])) / F.lit(stats[f"d_{f}"] or 1.0) * F.lit(float(w)) for f, w in zip(features, weights)})


# --- regression -------------------------------------------------------------------------
def polynomial_regression(train: DataFrame, rows: DataFrame, features: Sequence[str], target: str, degree: int = 4) -> DataFrame:
    steps = Pipeline(stages=[
        StandardScaler(inputCol="_x", outputCol="_s", withMean=True),  # the same polynomials; powers of plain values are too uneven to fit well
        PolynomialExpansion(degree=degree, inputCol="_s", outputCol="_p"),
        LinearRegression(featuresCol="_p", labelCol=target, predictionCol="predicted"),
    ])
    means = means_of(train, features)
    with held(vectors(train, features, "_x", means).select("_x", target)) as data:
        model = steps.fit(data)
    return model.transform(vectors(rows, features, "_x", means)).drop("_x", "_s", "_p")


def boosted_regression_by_group(
    train: DataFrame, rows: DataFrame, group: str, groups: Sequence[str], features: Sequence[str], target: str,
    capacity: str | None = None, trees: int = 100,
) -> DataFrame:
    """Boosted trees on the log target, one model per listed group; predictions back on the target's scale."""

    def fit(g: str) -> DataFrame:
        own = train.where(F.col(group) == g).withColumn("_y", F.log1p(F.col(target).cast("double")))
        means = means_of(own, features)
        data = vectors(own, features, "_x", means)
        with held(data.select("_x", "_y")) as fitted:
            model = GBTRegressor(featuresCol="_x", labelCol="_y", maxIter=trees, maxDepth=4, seed=SEED, predictionCol="_p").fit(fitted)
        out = model.transform(vectors(rows.where(F.col(group) == g), features, "_x", means))
        value = F.expm1("_p")
        return out.withColumn("predicted", clamp(value, capacity) if capacity else F.greatest(value, F.lit(0.0))).drop("_x", "_p")

    return reduce(DataFrame.unionByName, concurrently(fit, groups))


def boosted_log_regression(train: DataFrame, rows: DataFrame, features: Sequence[str], target: str, trees: int = 100) -> DataFrame:
    means = means_of(train, features)
    data = vectors(train.withColumn("_y", log_or_zero(target)), features, "_x", means).select("_x", "_y")
    with held(data) as fitted:
        model = GBTRegressor(featuresCol="_x", labelCol="_y", maxIter=trees, maxDepth=4, seed=SEED, predictionCol="_p").fit(fitted)
    return model.transform(vectors(rows, features, "_x", means)).withColumn("predicted", F.exp("_p")).drop("_x", "_p")


def price_table(
    prices: DataFrame, event: str, code: str, days_out: str, features: Sequence[str], target: str, codes: Sequence[str], trees: int = 100
) -> DataFrame:
    """Predicted price of each event's latest row per code, one column per code."""
    steps = Pipeline(stages=[
        MinMaxScaler(inputCol="_x", outputCol="_s"),
        GBTRegressor(featuresCol="_s", labelCol=target, maxIter=trees, maxDepth=4, seed=SEED, predictionCol="predicted"),
    ])
    train = prices.withColumn("_u", keyed_random([event, code, days_out], SEED)).where(F.col("_u") < 0.8)
    means = means_of(train, features)
    with held(vectors(train, features, "_x", means).select("_x", target)) as data:
        model = steps.fit(data)
    latest = prices.groupBy(event, code).agg(F.min_by(F.struct(*features), days_out).alias("_f")).select(
        event, code, *[F.col(f"_f.{f}").alias(f) for f in features if f not in (event, code)])
    return model.transform(vectors(latest, features, "_x", means)).groupBy(event).pivot(code, list(codes)).agg(F.first("predicted"))


def kernel_regression_by_group(
    train: DataFrame, rows: DataFrame, group: str, groups: Sequence[str], features: Sequence[str], target: str, capacity: str | None = None, kind: str = "rbf"
) -> DataFrame:
    """Kernel regression of the log target with an insensitive band, a model for each listed group; predictions on the target's scale."""
    scaled = lambda df: standardise(train, df.withColumns({f"_raw_{f}": F.col(f) for f in features}), features)
    model = kernel.fit(scaled(train).withColumn("_y", F.log1p(F.col(target).cast("double"))), features, "_y", group, groups, kind)
    out = kernel.predict(model, scaled(rows.where(F.col(group).isin(*groups))), features, group, "_p")
    value = F.expm1("_p")
    keep = [F.col(f"_raw_{x}").alias(x) if x in features else F.col(x) for x in rows.columns]
    return out.select(*keep, (clamp(value, capacity) if capacity else F.greatest(value, F.lit(0.0))).alias("predicted"))


def network_log_regression(train: DataFrame, rows: DataFrame, features: Sequence[str], target: str, hidden: Sequence[int] = (100,), alpha: float = 1e-3) -> DataFrame:
    """A network with one hidden layer on the log target; predictions on the target's scale."""
    model = network.fit(train.withColumn("_y", log_or_zero(target)), features, "_y", hidden, alpha)
    return network.predict(model, rows, features, "_p").withColumn("predicted", F.exp("_p")).drop("_p")


def network_price_table(
    prices: DataFrame, event: str, code: str, days_out: str, features: Sequence[str], target: str, codes: Sequence[str], hidden: Sequence[int] = (36, 18, 6)
) -> tuple[DataFrame, DataFrame]:
    """Predicted price of each event's latest row per code, one column per code; and all rows with draw ``_u`` and prediction.

    Rows with a draw of 0.8 or more are not trained on.
    """
    drawn = prices.withColumn("_u", keyed_random([event, code, days_out], SEED))
    model = network.fit(drawn.where(F.col("_u") < 0.8), features, target, hidden, scale="range")
    latest = prices.groupBy(event, code).agg(F.min_by(F.struct(*features), days_out).alias("_f")).select(
        event, code, *[F.col(f"_f.{f}").alias(f) for f in features if f not in (event, code)])
    table = network.predict(model, latest, features).groupBy(event).pivot(code, list(codes)).agg(F.first("predicted"))
    return table, network.predict(model, drawn, features)


# --- classification ----------------------------------------------------------------------
def standardise_by(train: DataFrame, rows: DataFrame, group: str, groups: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Features of ``rows`` by the mean and population deviation of their group's training rows; other groups are left out."""
    stats = {r[group]: r for r in train.where(F.col(group).isin(*groups)).groupBy(group).agg(
        *[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"d_{f}") for f in features]).collect()}

    def scaled(f: str):
        each = [F.when(F.col(group) == g, (F.col(f) - F.lit(r[f"m_{f}"])) / F.lit(r[f"d_{f}"] or 1.0)) for g, r in stats.items()]
        return F.coalesce(*each, F.lit(0.0))

    return rows.where(F.col(group).isin(*groups)).withColumns({f: scaled(f) for f in features})


def logistic_scores(
    train: DataFrame, rows: DataFrame, features: Sequence[str], label: str, weights: Sequence[float] | None = None,
    class_weight: str | None = None, c: float = 1.0,
) -> DataFrame:
    """Probability of the label by logistic regression on standardised, weighted features.

    The fit is deterministic, so the mean of repeated fits is one fit.  The penalty
    matches an inverse strength ``c`` on the summed loss.
    """
    one = lambda df: df.withColumn("_one", F.lit("one"))
    return logistic_scores_by(one(train), one(rows), "_one", {"one": weights or [1.0] * len(features)}, features, label, class_weight, c).drop("_one")


def logistic_scores_by(
    train: DataFrame, rows: DataFrame, group: str, weights: Mapping[str, Sequence[float]], features: Sequence[str], label: str,
    class_weight: str | None = None, c: float = 1.0,
) -> DataFrame:
    """``logistic_scores`` for each listed group with feature weights of its own; the fits share their passes."""
    groups = list(weights)
    solved, _ = _fit_by(train, group, weights, features, label, class_weight, c)
    raw = rows.withColumns({f"_raw_{f}": F.col(f) for f in features})
    new = standardise_by(train, raw, group, groups, features)
    chance = F.coalesce(*[F.when(F.col(group) == g, logistic.probability(features, p, weights[g])) for g, p in zip(groups, solved.parameters)])
    keep = [F.col(f"_raw_{x}").alias(x) if x in features else F.col(x) for x in rows.columns]
    return new.select(*keep, chance.alias("probability"))


def _fit_by(train, group, weights, features, label, class_weight=None, c=1.0):
    groups = list(weights)
    member = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col(group)) - 1
    with logistic.Trainer(standardise_by(train, train, group, groups, features), features, label, member, len(groups)) as trainer:
        return trainer.fit([logistic.Fit((i,), c, "l2", class_weight, tuple(map(float, weights[g]))) for i, g in enumerate(groups)])


def first_order(
    train: DataFrame, group: str, weights: Mapping[str, Sequence[float]], features: Sequence[str], label: str, c: float = 1.0
) -> DataFrame:
    """Rows of each group and how far its fit is from the optimum, from the scored training rows.

    ``excess``: probabilities minus labels, added up; ``pull``: the largest sum of residual times feature plus penalty.
    """
    solved, _ = _fit_by(train, group, weights, features, label, c=c)
    scaled = standardise_by(train, train, group, list(weights), features)
    chance = F.coalesce(*[F.when(F.col(group) == g, logistic.probability(features, p, weights[g])) for g, p in zip(weights, solved.parameters)])
    rest = (chance - F.col(label).cast("double")).alias("_r")
    sums = scaled.select(group, rest, *features).groupBy(group).agg(
        F.count("*").alias("n"), F.sum("_r").alias("excess"), *[F.sum(F.col("_r") * F.coalesce(F.col(f), F.lit(0.0))).alias(f"_{f}") for f in features])
    pulls = [F.when(F.col(group) == g, F.greatest(F.lit(0.0), *[
        F.abs(F.lit(float(w * c)) * F.col(f"_{f}") + F.lit(float(b))) for f, w, b in zip(features, weights[g], p)])) for g, p in zip(weights, solved.parameters)]
    return sums.select(group, "n", "excess", F.coalesce(*pulls).alias("pull"))


def coefficient_table(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Coefficient and odds ratio per feature."""
    solved, _ = _fit_by(train.withColumn("_one", F.lit("one")), "_one", {"one": [1.0] * len(features)}, features, label)
    rows = [(f, float(b)) for f, b in zip(features, solved.parameters[0])]
    return train.sparkSession.createDataFrame(rows, "feature string, coefficient double").withColumn("odds_ratio", F.exp("coefficient"))


def boosted_scores(train: DataFrame, rows: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 4) -> DataFrame:
    """Boosted-tree probability; the rare class weighs as much as the frequent one.

    Trees see a feature by its bins only, so rows of equal bins and label are one row with their summed weight:
    the passes of a fit are over the cells that occur, not over the rows.
    """
    counts = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    heavy = counts["n"] / max(counts["p"], 1)
    means = means_of(train, features)
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(means[f])) for f in features}
    names = [f"_b{i}" for i in range(len(features))]
    weighed = train.select(
        *[filled[f].alias(b) for f, b in zip(features, names)], F.col(label).cast("double").alias("_y"),
        F.when(F.col(label) == 1, F.lit(float(heavy))).otherwise(1.0).alias("_w"))
    with held(weighed) as own:
        borders = [bin_borders(own, b, "_w") for b in names]
        cells = cut_lineage(own.select("_y", "_w", *[bin_of(F.col(b), at).alias(b) for b, at in zip(names, borders)]).groupBy(*names, "_y").agg(F.sum("_w").alias("_w")))
    with held(vectors(cells, names, "_x").select("_x", "_y", "_w")) as fitted:
        model = GBTClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", maxIter=trees, maxDepth=depth, stepSize=0.1, seed=SEED).fit(fitted)
    out = model.transform(vectors(rows.withColumns({b: bin_of(filled[f], at) for f, b, at in zip(features, names, borders)}), names, "_x"))
    return out.select(*rows.columns, vector_to_array("probability")[1].alias("probability"))


#: Bins of a feature in boosted trees, as many as Spark's trees make, and the most steps of values from which they are put together.
BINS = 32
STEPS = 4096


def bin_borders(df: DataFrame, value: str, weight: str, bins: int = BINS, steps: int = STEPS) -> list[float]:
    """Borders between bins of even weight, midway between two values of the table; between all values if there are few.

    Of more than ``steps`` distinct values, neighbours by rank count as one step.
    """
    sizes = [F.min(value).alias("low"), F.max(value).alias("high"), F.sum(weight).alias("weight")]
    found = df.groupBy(value).agg(*sizes).limit(steps + 1).collect()
    if len(found) > steps:
        cuts = df.agg(F.percentile_approx(value, [i / steps for i in range(1, steps)], 10 * steps)).first()[0]
        cuts = [-math.inf, *sorted(set(cuts)), math.inf]
        found = Bucketizer(splits=cuts, inputCol=value, outputCol="_step", handleInvalid="keep").transform(df).groupBy("_step").agg(*sizes).collect()
    found = sorted(found, key=lambda r: (math.isnan(r["low"]), r["low"]))
    between = [(a["high"] + b["low"]) / 2 for a, b in zip(found, found[1:])]
    if len(found) <= bins:
        return between
    stride = sum(r["weight"] for r in found) / bins
    seen, target, out = found[0]["weight"], stride, []
    for border, r in zip(between, found[1:]):
        before, seen = seen, seen + r["weight"]
        if abs(before - target) < abs(seen - target):
            out.append(border)
            target += stride
    return out


def bin_of(value: Column, borders: Sequence[float]) -> Column:
    """Borders below the value."""
    return sum(((value > F.lit(b)).cast("double") for b in borders), F.lit(0.0))


def feature_importances(train: DataFrame, features: Sequence[str], label: str, trees: int = 100) -> DataFrame:
    with held(vectors(train, features, "_x", means_of(train, features)).select("_x", F.col(label).cast("double").alias("_y"))) as fitted:
        model = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=trees, maxDepth=4, seed=SEED).fit(fitted)
    values = model.featureImportances.toArray()
    return train.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")


def forest_classes(
    train: DataFrame, rows: DataFrame, features: Sequence[str], label: str, classes: Sequence[str], trees: int = 100, depth: int = 10
) -> DataFrame:
    """Random-forest class with one probability column per class; every level of depth is a pass, up to Spark's 30.

    A class that no training row has gets no share.  Without a training row no class is likelier than another:
    equal shares, and the first class.
    """
    if train.isEmpty():
        return rows.select("*", F.lit(classes[0]).alias("predicted"), *[F.lit(1.0 / len(classes)).alias(f"p_{c}") for c in classes])
    out = _classes(RandomForestClassifier(numTrees=trees, maxDepth=depth, maxMemoryInMB=512, seed=SEED), train, rows, features, label, classes)
    return out.fillna(0.0, [f"p_{c}" for c in classes])


def multinomial_classes(train: DataFrame, rows: DataFrame, features: Sequence[str], label: str, classes: Sequence[str]) -> DataFrame:
    """Multinomial logistic class on standardised features with one probability column per class."""
    scaled = standardise(train, train, features)
    raw = rows.withColumns({f"_raw_{f}": F.col(f) for f in features})
    out = _classes(LogisticRegression(family="multinomial", maxIter=50), scaled, standardise(train, raw, features), features, label, classes)
    return out.withColumns({f: F.col(f"_raw_{f}") for f in features}).drop(*[f"_raw_{f}" for f in features])


def _classes(learner, train, rows, features, label, classes):
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("double") - 1
    means = means_of(train, features)
    data = vectors(train.withColumn("_y", code), features, "_x", means).select("_x", "_y")
    learner.setFeaturesCol("_x").setLabelCol("_y").setProbabilityCol("_prob").setRawPredictionCol("_raw").setPredictionCol("_pred")
    with held(data) as fitted:
        model = learner.fit(fitted)
    out = model.transform(vectors(rows, features, "_x", means)).withColumn("_a", vector_to_array("_prob"))
    names = F.array(*[F.lit(c) for c in classes])
    return out.select(
        *rows.columns, F.element_at(names, (F.col("_pred") + 1).cast("int")).alias("predicted"),
        *[F.try_element_at("_a", F.lit(i + 1)).alias(f"p_{c}") for i, c in enumerate(classes)])


# --- clustering -----------------------------------------------------------------------------
def clusters(df: DataFrame, features: Sequence[str], k: int, name: str = "cluster", seed: int = 1693, starts: int = kmeans.STARTS) -> DataFrame:
    """KMeans on standardised features: the best of many starts."""
    return _placed(df.withColumn("_one", F.lit("one")), "_one", ["one"], features, k, name, seed, starts).drop("_one")


def _placed(df, group, groups, features, k, name, seed, starts):
    raw = df.withColumns({f"_raw_{f}": F.col(f) for f in features})
    scaled = standardise_by(df, raw, group, groups, features)
    out = kmeans.place(scaled, features, kmeans.fit(scaled, features, k, group, groups, starts, seed), group, name)
    return out.select(*[F.col(f"_raw_{c}").alias(c) if c in features else F.col(c) for c in df.columns], name)


def ranked_clusters(
    df: DataFrame, groups: Sequence[str], group: str, features: Sequence[str], worth: str, k: int, seed: int = 1693, starts: int = kmeans.STARTS
) -> DataFrame:
    """KMeans per group in shared passes, clusters renamed by the rank of their mean worth so labels agree across groups."""
    parts = cut_lineage(_placed(df, group, groups, features, k, "_c", seed, starts))
    means = parts.groupBy(group, "_c").agg(F.avg(worth).alias("_worth"))
    # k rows per group: the rank is a count over k values
    better = means.select(group, F.col("_worth").alias("_other"))
    rank = means.join(better, group).where(F.col("_other") <= F.col("_worth")).groupBy(group, "_c").agg(F.count("*").alias("cluster"))
    return parts.join(rank, [group, "_c"]).drop("_c")


def component_clusters(df: DataFrame, features: Sequence[str], components: int, k: int, seed: int = SEED, starts: int = kmeans.STARTS) -> DataFrame:
    """Principal components of encoded answers, clustered by the best of many starts."""
    data = vectors(df, features, "_x", means_of(df, features))
    with held(data.select("_x")) as fitted:
        pca = PCA(k=components, inputCol="_x", outputCol="_pc").fit(fitted)
    parts = [f"pc{i + 1}" for i in range(components)]
    projected = pca.transform(data).withColumn("_a", vector_to_array("_pc")).select(*df.columns, *[F.col("_a")[i].alias(p) for i, p in enumerate(parts)])
    return kmeans.place(projected, parts, kmeans.fit(projected, parts, k, starts=starts, seed=seed), name="target")


def inertia(df: DataFrame, features: Sequence[str], cluster: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, clusters and summed squared distance to the cluster's mean; ``strays``: rows nearer to another cluster's mean of their keys."""
    keys = list(keys)
    means = df.groupBy(*keys, cluster).agg(F.count("*").alias("_n"), F.array(*[F.avg(f) for f in features]).alias("_mean"))
    all_means = means.groupBy(*keys).agg(F.collect_list(F.struct(F.col(cluster).alias("c"), F.col("_mean").alias("m"))).alias("_all"))  # one entry a cluster
    rows = df.join(all_means, keys) if keys else df.join(F.broadcast(all_means), F.lit(True))
    apart = lambda m: sum(((F.col(f) - m[i]) ** 2 for i, f in enumerate(features)), F.lit(0.0))
    ranked = F.transform("_all", lambda x: F.struct(apart(x["m"]).alias("d"), x["c"].alias("c")))
    seen = rows.withColumn("_d", ranked).select(
        *keys, cluster, F.array_min(F.transform("_d", lambda x: x["d"])).alias("least"),
        F.array_min(F.transform(F.filter("_d", lambda x: x["c"] == F.col(cluster)), lambda x: x["d"])).alias("own"))
    return seen.groupBy(*keys).agg(
        F.count("*").alias("n"), F.countDistinct(cluster).alias("clusters"), F.sum("own").alias("inertia"),
        F.count_if(F.col("own") > F.col("least") * (1 + 1e-6) + 1e-9).alias("strays"))


# --- evaluation --------------------------------------------------------------------------------
def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(ratio(F.count_if(F.col(actual) == F.col(predicted)), F.count("*")).alias("accuracy"))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, all from the confusion counts."""
    cells = confusion(df, actual, predicted)
    hit = F.col(actual) == F.col(predicted)
    support = cells.groupBy(F.col(actual).alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"))
    called = cells.groupBy(F.col(predicted).alias("class")).agg(F.sum("n").alias("called"))
    both = support.join(called, "class", "outer").fillna(0)
    precision, recall = F.coalesce(ratio("tp", "called"), F.lit(0.0)), F.coalesce(ratio("tp", "support"), F.lit(0.0))
    return both.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        F.coalesce(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)), F.lit(0.0)).alias("f1"), "support")


def roc_auc(df: DataFrame, label: str, score: str, bucket) -> DataFrame:
    """Exact area under the ROC curve from average ranks of the positives.

    Ranks come from counted score values, so ties and hot values cost one row each.
    """
    counts = df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("_n"))
    ranks = counted_values(df, [], score, bucket).withColumn("rank", F.col("upto") - (F.col("n") - 1) / 2.0)
    joined = counts.join(ranks, score)
    p, n = F.sum("pos").cast("double"), F.sum("_n").cast("double")
    return joined.agg(((F.sum(F.col("pos") * F.col("rank")) - p * (p + 1) / 2) / (p * (n - p))).alias("auc"))


def folded(train: DataFrame, features: Sequence[str], folds: int):
    """Fold number of a row by its features."""
    return F.pmod(F.xxhash64(F.lit(SEED), *features), F.lit(folds))


def grid_search(
    train: DataFrame, features: Sequence[str], label: str, strengths: Sequence[float], penalties: Sequence[str], class_weights: Sequence[str | None], folds: int = 5
) -> DataFrame:
    """Cross-validated accuracy of each logistic setting; all settings and folds are fitted in the same passes."""
    scaled = standardise(train, train.withColumn("_fold", folded(train, features, folds)), features)
    settings = [(c, p, w) for c in strengths for p in penalties for w in class_weights]
    plan = [(logistic.Fit(tuple(m for m in range(folds) if m != f), c, p, w), f) for c, p, w in settings for f in range(folds)]
    with logistic.Trainer(scaled, features, label, F.col("_fold"), folds) as trainer:
        solved, fits = trainer.fit([one for one, _ in plan])
        right = trainer.accuracy(solved, fits, [f for _, f in plan]).reshape(len(settings), folds).mean(1)
    gap = solved.gap.reshape(len(settings), folds).max(1)
    rows = [(float(c), p, w or "none", float(a), bool(a == right.max()), bool(g <= 1e-5), solved.passes) for (c, p, w), a, g in zip(settings, right, gap)]
    return train.sparkSession.createDataFrame(rows, "strength double, penalty string, class_weight string, accuracy double, is_best boolean, at_optimum boolean, passes int")


def eliminate_features(train: DataFrame, features: Sequence[str], label: str, folds: int = 5) -> DataFrame:
    """Drop the weakest coefficient step by step; accuracy per number of features by cross-validation.

    Each fold and the whole table eliminate for themselves, side by side; the names are those of the whole table.
    """
    scaled = standardise(train, train.withColumn("_fold", folded(train, features, folds)), features)
    members = [tuple(m for m in range(folds) if m != f) for f in range(folds)] + [tuple(range(folds))]
    left, rows, start = [list(range(len(features))) for _ in members], [], None
    with logistic.Trainer(scaled, features, label, F.col("_fold"), folds) as trainer:
        while left[-1]:
            fits = [logistic.Fit(m, scales=tuple(float(i in own) for i in range(len(features)))) for m, own in zip(members, left)]
            solved, made = trainer.fit(fits, start)
            right = trainer.accuracy(solved, made, [*range(folds), 0])[:folds]
            weakest = [min(own, key=lambda i, p=p: (abs(p[i]), i)) for own, p in zip(left, solved.parameters)]
            rows.append((len(left[-1]), float(right.mean()), features[weakest[-1]], ",".join(features[i] for i in left[-1]), bool(solved.gap.max() <= 1e-5)))
            for own, i in zip(left, weakest):
                own.remove(i)
            start = solved.parameters
    return train.sparkSession.createDataFrame(rows, "n_features int, accuracy double, dropped string, kept string, at_optimum boolean")
