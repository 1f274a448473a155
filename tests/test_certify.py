"""Certificates hold for what was fitted, and not for anything else."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kestrel.operators import certify, ml
from kestrel.plans import models

TAGS = [(1, "value", "", 4, 0)] + [(2 + i, f"rank{i}", str(i), 5, 1) for i in range(3)]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.2).astype(float)
    return spark.createDataFrame([(i, [float(v) for v in r], float(t), float(3 * r[0] - r[2] + 5))
                                  for i, (r, t) in enumerate(zip(x, y))],
                                 "id long, a array<double>, label double, total double").select(
        "id", array_to_vector("a").alias("features"), "label", "total").cache()


def test_clusters(spark):
    rng = np.random.default_rng(3)
    users = spark.createDataFrame([(i, float(rng.normal(10 * (i % 3))), float(rng.normal(5 * (i % 3)))) for i in range(90)]
                                  + [(900, None, 1.0)], "userId long, a double, b double")
    tags = spark.createDataFrame(TAGS, "id long, name string, rule string, level int, pid long")
    fit = models.cluster_users(users, ["a", "b"], 3)
    c = one(certify.clusters(fit, tags))
    total = users.where("a IS NOT NULL").agg(F.round(F.sum(F.col("a") + F.col("b")), 3)).first()[0]
    assert c == {"n_users": 91, "n_untagged": 1, "n_mistagged": 0, "n_not_nearest": 0, "centres_are_means": True,
                 "cost_adds_up": True, "coordinate_sum": total}
    # stopped early: its centres are not yet the means of their users
    early = KMeans(k=3, maxIter=1, seed=1, featuresCol="raw", initMode="random").fit(fit.data)
    rough = one(certify.clusters(models.ClusterFit(early, fit.data, "raw", fit.missing), tags))
    assert not (rough["centres_are_means"] and rough["cost_adds_up"])


@pytest.mark.parametrize("implicit", [True, False])
def test_factors(spark, implicit):
    rng = np.random.default_rng(4)
    rows = [(f"u{u}", f"p{i}", float(rng.integers(1, 5))) for u in range(30) for i in rng.permutation(20)[:6].tolist()]
    ratings = spark.createDataFrame(rows, "u string, i string, r double")
    if implicit:
        logs = ratings.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("r").cast("int"))))
        m, reg = models.preference_model(logs, user="u", item=F.col("i"), rank=4, max_iter=3), 1.0
    else:
        m, reg = models.rating_model(ratings, user="u", item="i", rating="r", rank=4, max_iter=3), 0.1
    c = one(certify.factors(m, reg=reg, implicit=implicit, n=3))
    assert c == {"n_users": 30, "n_unsolved": 0, "n_ratings": 180, "n_items": 20, "n_lists_off": 0, "n_recommended": 90}
    assert one(certify.factors(m, reg=3 * reg, implicit=implicit, n=3))["n_unsolved"] > 20
    assert one(certify.factors(m, reg=reg, implicit=not implicit, n=3))["n_unsolved"] > 20


@pytest.mark.parametrize("kind,params", [("tree", {"maxDepth": 4}), ("forest", {"numTrees": 7}), ("gbt", {"maxIter": 4})])
def test_trees(vectors, kind, params):
    model = ml.classifier(kind, **params).fit(vectors)
    c = one(certify.trees(model, vectors, vectors if kind == "tree" else None))
    assert c["n_rows"] == 240 and c["n_replayed_off"] == 0 and c["n_labelled_1"] == vectors.where("label = 1").count()
    if kind == "tree":
        assert c["n_leaves_off"] == 0
        flipped = vectors.withColumn("label", 1 - F.col("label"))
        assert one(certify.trees(model, flipped, flipped))["n_leaves_off"] > 0


def test_trees_with_categories_and_weights(spark):
    df = spark.createDataFrame([(float(i % 5), float(i % 3), float(i % 5 in (1, 4)), 1.0 + i % 2) for i in range(120)],
                               "c double, d double, label double, w double")
    pipe = ml.tree_pipeline(["c", "d"], weight="w").fit(df)
    rows = pipe.stages[1].transform(pipe.stages[0].transform(df))
    c = one(certify.trees(pipe.stages[2], rows, rows, weight="w"))
    assert c["n_rows"] == 180 and c["n_replayed_off"] == 0 and c["n_leaves_off"] == 0


def test_coefficients(vectors):
    m = ml.classifier("logistic", maxIter=20).fit(vectors)
    assert one(certify.logistic(m, vectors, vectors)) == {"n_rows": 240, "n_replayed_off": 0, "no_worse_than_constant": True}
    flipped = vectors.withColumn("label", 1 - F.col("label"))
    assert not one(certify.logistic(m, flipped, flipped))["no_worse_than_constant"]
    three = vectors.withColumn("label", (F.col("id") % 3).cast("double"))
    multi = ml.classifier("logistic", family="multinomial", maxIter=10).fit(three)
    assert one(certify.logistic(multi, three, three)) == {"n_rows": 240, "n_replayed_off": 0, "no_worse_than_constant": True}
    exact = ml.linear_regression(label="total", regParam=0.0, elasticNetParam=0.0).fit(vectors)
    good = {"n_rows": 240, "n_replayed_off": 0, "residuals_cancel": True, "gradient_vanishes": True}
    noisy = vectors.withColumn("total", F.col("total") + F.sin(F.col("id")))
    fitted = ml.linear_regression(label="total", regParam=0.0, elasticNetParam=0.0).fit(noisy)
    assert one(certify.linear(fitted, noisy, noisy, label="total")) == good
    off = one(certify.linear(exact, noisy, noisy.where("id % 2 = 0").withColumn("total", F.col("total") * 2), label="total"))
    assert not off["gradient_vanishes"]


def test_search_prepares_once_and_equals_search_over_all_lines(spark):
    """Counted lines give the trees that the lines themselves give."""
    lines = spark.createDataFrame([(i % 7, f"b{i % 6}", f"t{i % 4}", int(i % 6 in (0, 3) or (i % 4 == 1 and i % 5 == 0)), i % 3)
                                   for i in range(600)], "userId int, brand string, ptype string, label int, f int")
    search = models.usg_search(lines, categorical=["brand", "ptype"], fold=F.col("f"))
    assert len(search.settings) == len(search.scores) == 8 and search.rows.count() < 200
    assert search.rows.agg(F.sum("weight")).first()[0] == 600
    # the first setting's folds, fitted on the lines one by one
    stages = search.pipeline.stages
    rows = lines.withColumn("label", F.col("label").cast("double"))
    for s in stages[:-1]:
        rows = s.transform(rows)
    impurity, depth, bins = search.settings[0]
    scores = []
    for k in range(3):
        tree = ml.classifier("tree", impurity=impurity, maxDepth=depth, maxBins=bins).fit(rows.where(F.col("f") != k))
        scores.append(ml.accuracy(tree.transform(rows.where(F.col("f") == k))))
    assert abs(np.mean(scores) - search.scores[0]) < 1e-9
    assert one(certify.trees(stages[-1], search.rows, search.rows, weight="weight"))["n_leaves_off"] == 0
