"""The model demos' flows on generated rows (their datasets are not bundled here)."""

import random

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from kestrel.operators import cleanup, ml
from kestrel.sources import meta


def test_survival_flow_impute_onehot_logistic(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        sex = "female" if i % 2 else "male"
        age = None if i % 10 == 0 else float(rnd.randint(1, 70))
        survived = 1.0 if sex == "female" else 0.0
        rows.append((i, sex, age, rnd.choice(["S", "C", "Q"]), survived))
    df = spark.createDataFrame(rows, "pid int, sex string, age double, embarked string, label double")
    filled = cleanup.mean_impute(df, ["age"])
    assert filled.where(F.col("age").isNull()).count() == 0
    pipe = Pipeline(stages=[
        StringIndexer(inputCols=["sex", "embarked"], outputCols=["sex_i", "emb_i"]),
        OneHotEncoder(inputCols=["sex_i", "emb_i"], outputCols=["sex_v", "emb_v"], dropLast=False),
    ])
    feats = ml.assemble(pipe.fit(filled).transform(filled), ["sex_v", "emb_v", "age"])
    train, test = feats.randomSplit([0.8, 0.2], seed=31)
    model = ml.classifier("logistic", maxIter=50, regParam=0.01, elasticNetParam=0.5).fit(train)
    assert ml.accuracy(model.transform(test)) == 1.0
    assert model.summary.totalIterations > 0


def test_multinomial_logistic_three_classes(spark):
    rnd = random.Random(3)
    rows = [(float(c * 5 + rnd.random()), float(c * 3 + rnd.random()), f"class{c}")
            for c in range(3) for _ in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, cls string")
    idx = StringIndexer(inputCol="cls", outputCol="label").fit(df).transform(df)
    data = ml.std_scale(ml.assemble(idx, ["x", "y"]), out="features_std")
    model = ml.classifier("logistic", features="features_std", family="multinomial", maxIter=20,
                          regParam=0.0).fit(data)
    pred = model.transform(data)
    assert ml.accuracy(pred) == 1.0
    assert ml.accuracy(pred, metric="weightedPrecision") == 1.0
    assert model.coefficientMatrix.numRows == 3


def test_linear_regression_from_whitespace_lines(spark, tmp_path):
    rnd = random.Random(5)
    lines = []
    for _ in range(200):
        a, b = rnd.uniform(0, 10), rnd.uniform(0, 10)
        lines.append(f" {a:.4f}   {b:.4f}  {3 * a - 2 * b + 1:.4f}")
    lines.append("1.0 2.0")  # wrong width: dropped
    path = tmp_path / "housing.data"
    path.write_text("\n".join(lines) + "\n")
    raw = spark.read.text(str(path))
    df = meta.parse_delimited_lines(raw, ["a", "b", "label"], r"\s+", regex=True,
                                    types={"a": "double", "b": "double", "label": "double"})
    assert df.count() == 200
    data = ml.assemble(df, ["a", "b"])
    model = ml.linear_regression(regParam=0.0, elasticNetParam=0.0).fit(data)
    assert ml.rmse(model.transform(data)) < 1e-3


def test_trees_forest_gbt_on_libsvm(spark, tmp_path):
    rnd = random.Random(11)
    lines = []
    for _ in range(120):
        x1, x2 = rnd.random(), rnd.random()
        lines.append(f"{1 if x1 > 0.5 else 0} 1:{x1:.4f} 2:{x2:.4f}")
    p = tmp_path / "sample_libsvm.txt"
    p.write_text("\n".join(lines) + "\n")
    df = spark.read.format("libsvm").option("numFeatures", 2).load(str(p))
    for kind, params in (("tree", {"maxDepth": 5, "impurity": "entropy", "maxBins": 32}),
                         ("forest", {}), ("gbt", {})):
        model = ml.classifier(kind, **params).fit(df)
        assert ml.accuracy(model.transform(df)) > 0.95, kind


def test_explicit_als_from_pipe_separated_lines(spark, tmp_path):
    rows = [f"{u}|{i}|{(u + i) % 5 + 1}|881250949" for u in range(1, 21) for i in range(1, 16) if (u * i) % 3]
    p = tmp_path / "u.data"
    p.write_text("\n".join(rows) + "\n")
    ratings = meta.read_delimited(spark, str(p), "user int, item int, rating double, ts long", sep="|")
    from kestrel.plans import models
    m = models.rating_model(ratings, user="user", item="item", rating="rating", rank=5, max_iter=10)
    assert m.rmse < 2.5
    subset = ratings.select(F.col("user").alias("userId")).distinct().orderBy("userId").limit(3)
    assert models.top_items_per_user(m, 4, subset).count() == 3
