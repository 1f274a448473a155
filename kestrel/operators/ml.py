"""Spark ML pieces behind the mining tags and the model demos.

All training is distributed Spark ML.  The only values that reach the driver
are model parameters: k cluster centres, tree nodes, ALS factor counts.
Inputs that an estimator scans many times are persisted (memory and disk)
and released after fitting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import (ClusteringEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler, VectorIndexer
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Seed and iteration sweep of the clustering tags.
KMEANS_SEED = 31
KMEANS_SWEEP_ITERS = (5, 10, 20)


def assemble(df: DataFrame, cols: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Vector column from numeric columns.  ``handle_invalid``: ``error``
    (fail on a null), ``skip`` (drop the row) or ``keep`` (NaN)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_to_array(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    from pyspark.ml.functions import vector_to_array as v2a
    return df.withColumn(out or col, v2a(F.col(col)))


def min_max_scale(df: DataFrame, col: str = "features", out: str = "scaled") -> DataFrame:
    return MinMaxScaler(inputCol=col, outputCol=out).fit(df).transform(df)


def std_scale(df: DataFrame, col: str = "features", out: str = "scaled",
              with_mean: bool = False, with_std: bool = True) -> DataFrame:
    return (StandardScaler(inputCol=col, outputCol=out, withMean=with_mean, withStd=with_std)
            .fit(df).transform(df))


def kmeans(df: DataFrame, k: int, *, max_iter: int = 20, seed: int = KMEANS_SEED,
           features: str = "features", init: str = "k-means||",
           distance: str = "euclidean", weight: str | None = None) -> KMeansModel:
    km = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features, initMode=init,
                distanceMeasure=distance)
    if weight:
        km = km.setWeightCol(weight)
    return km.fit(df)


def parallel_fits(fit, settings, parallelism: int = 4) -> list:
    """``[fit(s) for s in settings]`` with the fits submitted as concurrent
    Spark jobs (as ``CrossValidator(parallelism=...)`` does); order kept."""
    settings = list(settings)
    if parallelism <= 1 or len(settings) <= 1:
        return [fit(s) for s in settings]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(settings))) as pool:
        return list(pool.map(fit, settings))


def kmeans_sweep(df: DataFrame, k: int, *, iters=KMEANS_SWEEP_ITERS, seed: int = KMEANS_SEED,
                 features: str = "features", weight: str | None = None,
                 parallelism: int = 3) -> KMeansModel:
    """Fit one model per ``maxIter`` and keep the lowest within-cluster cost
    (first of the sweep on a tie).  The fits run concurrently on the cluster."""
    cols = [features] + ([weight] if weight else [])
    data = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = parallel_fits(lambda i: kmeans(data, k, max_iter=i, seed=seed, features=features,
                                                weight=weight), iters, parallelism)
    finally:
        data.unpersist()
    return min(models, key=lambda m: m.summary.trainingCost)


def rank_centers(model: KMeansModel) -> DataFrame:
    """``(cluster, rank)``: clusters ordered by descending sum of their centre
    coordinates (rank 0 = largest); ties keep the lower cluster index first.

    Only the clusters the model actually has are ranked (a model may end with
    fewer than k centres on few distinct points).
    """
    spark = model.summary.predictions.sparkSession if model.hasSummary else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    rows = [(i, float(sum(c))) for i, c in enumerate(model.clusterCenters())]
    centers = spark.createDataFrame(rows, "cluster int, s double")
    return rank_center_table(centers)


def rank_center_table(centers: DataFrame, cluster: str = "cluster", total: str = "s") -> DataFrame:
    """``(cluster, rank)`` from a table of centre sums (k rows)."""
    w = Window.orderBy(F.col(total).desc(), F.col(cluster).asc())
    return centers.select(F.col(cluster).alias("cluster"), (F.row_number().over(w) - 1).alias("rank"))


@dataclass
class ModelStore:
    """Fitted models under one shared folder; ``load_or_train`` reuses a saved
    model unless ``retrain`` is set."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        spark = SparkSession.getActiveSession()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def load_or_train(self, name: str, loader, train, retrain: bool = False):
        """The saved model, or a new one that is then saved.

        Only a missing model is trained; one that exists but doesn't load (another
        type, a damaged folder) is an error and stays as it is.
        """
        p = self.path(name)
        if not retrain and self.exists(name):
            return loader.load(p)
        model = train()
        model.write().overwrite().save(p)
        return model


def tree_pipeline(features: list[str], label: str = "label", *, impurity: str = "gini",
                  max_depth: int = 5, max_bins: int = 32, max_categories: int = 30,
                  weight: str | None = None) -> Pipeline:
    """Assembler -> categorical indexer -> decision tree (optionally weighted)."""
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="features", impurity=impurity,
                                  maxDepth=max_depth, maxBins=max_bins)
    if weight:
        tree = tree.setWeightCol(weight)
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep"),
        VectorIndexer(inputCol="raw_features", outputCol="features", maxCategories=max_categories,
                      handleInvalid="keep"),
        tree,
    ])


def cross_validate(pipeline: Pipeline, df: DataFrame, *, label: str = "label", folds: int = 3,
                   impurities=("gini", "entropy"), depths=(5, 10), bins=(32, 64),
                   metric: str = "accuracy", seed: int = KMEANS_SEED, parallelism: int = 4,
                   weight: str | None = None):
    """k-fold search over impurity x depth x bins of the pipeline's tree."""
    tree = pipeline.getStages()[-1]
    grid = (ParamGridBuilder().addGrid(tree.impurity, list(impurities))
            .addGrid(tree.maxDepth, list(depths)).addGrid(tree.maxBins, list(bins)).build())
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    if weight:
        ev = ev.setWeightCol(weight)
    return CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=ev,
                          numFolds=folds, seed=seed, parallelism=parallelism).fit(df)


@dataclass
class TreeSearch:
    """The settings tried (impurity, depth, bins), the mean metric of each over the folds, the
    best setting, and the fitted pipeline: the preparation and the best tree on all rows."""

    settings: list[tuple]
    scores: list[float]
    best: tuple
    pipeline: PipelineModel
    rows: DataFrame     # the prepared rows all fits worked on


def search_trees(prepare: Pipeline, df: DataFrame, *, label: str = "label", weight: str | None = None,
                 fold: str = "fold", folds: int = 3, impurities=("gini", "entropy"), depths=(5, 10),
                 bins=(32, 64), metric: str = "accuracy", seed: int = KMEANS_SEED,
                 parallelism: int = 4) -> TreeSearch:
    """k-fold search over impurity x depth x bins that prepares the features once.

    ``prepare`` (indexers, assembler) is fitted once on all rows and its output cached;
    only trees are fitted per setting and fold.  A row's fold is the number in column
    ``fold``, so the folds can be given, and checked, as data.  The first of equally
    good settings wins.
    """
    from itertools import product
    fitted = prepare.fit(df)
    rows = fitted.transform(df).persist(StorageLevel.MEMORY_AND_DISK)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    if weight:
        ev = ev.setWeightCol(weight)

    def tree(setting):
        t = DecisionTreeClassifier(labelCol=label, featuresCol="features", impurity=setting[0],
                                   maxDepth=setting[1], maxBins=setting[2], seed=seed)
        return t.setWeightCol(weight) if weight else t

    def one(job):
        setting, k = job
        test = rows.where(F.col(fold) == k)
        return ev.evaluate(tree(setting).fit(rows.where(F.col(fold) != k)).transform(test))

    settings = list(product(impurities, depths, bins))
    try:
        # a fold that got no rows measures nothing
        held = [r[0] for r in rows.groupBy(fold).count().orderBy(fold).select(fold).collect()]
        held = held if len(held) > 1 else []
        jobs = [(s, k) for s in settings for k in held]
        found = dict(zip(jobs, parallel_fits(one, jobs, parallelism)))
        scores = [sum(found[s, k] for k in held) / len(held) if held else float("nan") for s in settings]
        best = max(range(len(settings)), key=lambda i: (scores[i] if held else 0, -i))
        model = tree(settings[best]).fit(rows)
    finally:
        rows.unpersist()
    return TreeSearch(settings, scores, settings[best], PipelineModel(stages=[*fitted.stages, model]), rows)


def train_validation_split(pipeline: Pipeline, df: DataFrame, *, label: str = "label",
                           ratio: float = 0.8, impurities=("gini", "entropy"),
                           depths=(5, 10), seed: int = KMEANS_SEED):
    tree = pipeline.getStages()[-1]
    grid = (ParamGridBuilder().addGrid(tree.impurity, list(impurities))
            .addGrid(tree.maxDepth, list(depths)).build())
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, evaluator=ev,
                                trainRatio=ratio, seed=seed).fit(df)


def classifier(kind: str, label: str = "label", features: str = "features", **params):
    """``tree``, ``forest`` (20 trees), ``gbt`` (10 iterations, step 0.1) or ``logistic``."""
    if kind == "tree":
        return DecisionTreeClassifier(labelCol=label, featuresCol=features, **params)
    if kind == "forest":
        return RandomForestClassifier(labelCol=label, featuresCol=features,
                                      **{"numTrees": 20, "seed": KMEANS_SEED, **params})
    if kind == "gbt":
        return GBTClassifier(labelCol=label, featuresCol=features,
                             **{"maxIter": 10, "stepSize": 0.1, "seed": KMEANS_SEED, **params})
    if kind == "logistic":
        return LogisticRegression(labelCol=label, featuresCol=features, **params)
    raise ValueError(f"unknown classifier {kind!r}")


def linear_regression(label: str = "label", features: str = "features", **params):
    return LinearRegression(labelCol=label, featuresCol=features,
                            **{"solver": "auto", "elasticNetParam": 0.5, "regParam": 0.01, **params})


def accuracy(pred: DataFrame, label: str = "label", metric: str = "accuracy") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric).evaluate(pred)


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName="rmse").evaluate(pred)


def silhouette(pred: DataFrame, features: str = "features", distance: str = "squaredEuclidean",
               weight: str | None = None) -> float:
    ev = ClusteringEvaluator(featuresCol=features, distanceMeasure=distance)
    if weight:
        ev = ev.setWeightCol(weight)
    return ev.evaluate(pred)


def elbow(df: DataFrame, ks=range(2, 7), *, features: str = "features", max_iter: int = 50,
          seed: int = KMEANS_SEED, distance: str = "euclidean", parallelism: int = 4) -> list[dict]:
    """KMeans for each k: cost, silhouette and cluster sizes (k small rows each)."""
    data = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)

    def one(k):
        m = kmeans(data, k, max_iter=max_iter, seed=seed, features=features, distance=distance)
        ev = "cosine" if distance == "cosine" else "squaredEuclidean"
        sizes = [int(n) for n in m.summary.clusterSizes]
        # silhouette is undefined with a single non-empty cluster
        sil = (float(silhouette(m.transform(data), features, ev)) if sum(1 for n in sizes if n > 0) > 1
               else float("nan"))
        return {"k": k, "cost": float(m.summary.trainingCost), "silhouette": sil, "sizes": sizes}

    try:
        return parallel_fits(one, ks, parallelism)
    finally:
        data.unpersist()


# --- matrix factorisation ---------------------------------------------------

INT_MAX = 2**31 - 1


def int_ids(df: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Ids ALS can take (32-bit ints) for ids of any type, strings included.

    The distinct ids are numbered densely without a global sort: each partition
    of the distinct set numbers its ids, and partition offsets (one row per
    partition) shift them.  Rows with a null id are left out.  Returns the data
    with ``out`` and the ``(out, col)`` mapping.
    """
    df = df.where(F.col(col).isNotNull())
    distinct = df.select(col).distinct().withColumn("__pid", F.spark_partition_id())
    w = Window.partitionBy("__pid").orderBy(col)
    numbered = distinct.withColumn("__rn", F.row_number().over(w))
    # number once: the offsets and the mapping must see the same partitions
    from kestrel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    numbered = numbered.checkpoint()
    counts = numbered.groupBy("__pid").agg(F.max("__rn").alias("__n"))
    offs = counts.withColumn("__off", F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n"))
    from kestrel.operators.broadcast import checked_broadcast
    mapping = (numbered.join(checked_broadcast(offs.select("__pid", "__off")), "__pid")
               .select((F.col("__off") + F.col("__rn") - 1).cast("int").alias(out), F.col(col)))
    if numbered.count() > INT_MAX:
        raise ValueError(f"more than 2^31 distinct {col} values")
    return df.join(mapping, col), mapping


def als(implicit: bool, *, user: str = "userId", item: str = "itemId", rating: str = "rating",
        rank: int = 10, max_iter: int = 10, reg: float = 1.0, alpha: float = 1.0,
        seed: int = KMEANS_SEED, checkpoint_interval: int = 5, blocks: int | None = None) -> ALS:
    a = ALS(userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=implicit, rank=rank,
            maxIter=max_iter, regParam=reg, alpha=alpha, seed=seed, coldStartStrategy="drop",
            checkpointInterval=checkpoint_interval)
    if blocks:
        a = a.setNumBlocks(blocks)
    return a
