"""Model-backed queries on the shop tables (row-count checked) and the
feature transforms they use (SQL checked)."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import certify, ml
from kestrel.plans import models
from kestrel.plans import shop
from kestrel.plans.shop import Tables, shop_tags


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


RFM_COLS = ["r_score", "f_score", "m_score"]


RFE_COLS = ["r_score", "f_score", "e_score"]


def _rfm_fit(spark, sf_dir, **kw):
    return models.cluster_users(shop.rfm_scores(spark, sf_dir), RFM_COLS, 5, **kw)


def _rfm_scaled_fit(spark, sf_dir):
    return _rfm_fit(spark, sf_dir, scale=True, sweep=(10, 20, 50))


def _rfe_fit(spark, sf_dir):
    return models.cluster_users(shop.rfe_scores(spark, sf_dir), RFE_COLS, 4)


def _psm_fit(spark, sf_dir):
    return models.cluster_users(shop.psm_score(spark, sf_dir), ["psm"], 5)


def _rfm_tags(spark):
    return shop_tags(spark, shop.RFM_TAG, "customer value", shop.RFM_RULES)


def _rfe_tags(spark):
    return shop_tags(spark, shop.RFE_TAG, "activity", shop.RFE_RULES)


def _psm_tags(spark):
    return shop_tags(spark, shop.PSM_TAG, "price sensitivity", shop.PSM_RULES)


def rfm_kmeans(spark, sf_dir):
    return _rfm_fit(spark, sf_dir, sweep=None).tagged(_rfm_tags(spark), "rfm")


def rfm_scaled_kmeans(spark, sf_dir):
    """The tuned variant: scores scaled to 0..1, the best of 10, 20 and 50 iterations."""
    return _rfm_scaled_fit(spark, sf_dir).tagged(_rfm_tags(spark), "rfm")


def rfe_kmeans(spark, sf_dir):
    return _rfe_fit(spark, sf_dir).tagged(_rfe_tags(spark), "rfe")


def psm_kmeans(spark, sf_dir):
    return _psm_fit(spark, sf_dir).tagged(_psm_tags(spark), "psm")


def _elbow_rows(spark, rows):
    return spark.createDataFrame(
        [(r["k"], r["cost"], r["silhouette"], r["sizes"]) for r in rows],
        "k int, cost double, silhouette double, sizes array<int>").select(
        "k", "cost", "silhouette", F.array_join(F.col("sizes").cast("array<string>"), ",").alias("sizes"))


def elbow(spark, sf_dir):
    scores = ml.assemble(shop.rfm_scores(spark, sf_dir), RFM_COLS)
    return _elbow_rows(spark, ml.elbow(scores, range(2, 7), max_iter=50))


def _line_fold():
    """Fold of an order line in the tree search."""
    return (F.col("l_orderkey") + F.col("l_linenumber")) % 3


def usg_tree(spark, sf_dir):
    lines = shop.labelled_lines(_t(spark, sf_dir))
    tags = shop_tags(spark, shop.USG_TAG, "purchase gender", shop.USG_RULES)
    return models.usg_learned_tag(lines, tags, categorical=["brand", "ptype"], fold=_line_fold())


def _clicks(spark, sf_dir):
    """Click events and the item each is about."""
    return (_t(spark, sf_dir).events.where(F.col("event_type") == "click"),
            {"user": "user_id", "item": F.get_json_object("props", "$.k").try_cast("long")})


def bp_als_top5(spark, sf_dir):
    logs, columns = _clicks(spark, sf_dir)
    return models.preference_tag(logs, top_n=5, **columns)


def als_explicit_top5(spark, sf_dir):
    """Clicks as explicit ratings: split, fit, then the top 5 users of every item."""
    return models.top_users_per_item(_rating_model(spark, sf_dir), 5)


def _rating_model(spark, sf_dir, measure=False):
    ratings = shop.click_counts(_t(spark, sf_dir))
    return models.rating_model(ratings, user="userId", item="productId", rating="clicks", measure=measure)


def als_explicit_top5_items(spark, sf_dir):
    """The other direction: the top 5 items of every user."""
    return models.top_items_per_user(_rating_model(spark, sf_dir), 5)


def als_explicit_rmse(spark, sf_dir):
    """The error on held-out pairs and how many users and items have factors."""
    m = _rating_model(spark, sf_dir, measure=True)
    n = [m.factors(side).agg(F.count(F.lit(1)).alias(side)) for side in ("users", "items")]
    return n[0].withColumn("rmse", F.lit(m.rmse)).join(n[1], F.lit(True))


def _doc_features(spark, sf_dir):
    t = _t(spark, sf_dir)
    d = t.documents.select("doc_id", "n_chars", "lang", "source")
    lab = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    j = d.join(lab, "doc_id")
    j = StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"],
                      handleInvalid="keep").fit(j).transform(j)
    j = j.withColumn("log_chars", F.log1p(F.col("n_chars").cast("double")))
    return ml.assemble(j, ["log_chars", "lang_i", "source_i"])


def _split_fit(data, estimator):
    """A model of a seeded 80 % of the rows, and those and the other rows."""
    train, test = data.randomSplit([0.8, 0.2], seed=ml.KMEANS_SEED)
    return estimator.fit(train), train, test


def _classify(kind, spark, sf_dir, **params):
    """Fit on a seeded 80 % split, score every labelled document: label, prediction, the
    probability of label 1, and the accuracy on the other 20 %."""
    data = _doc_features(spark, sf_dir)
    model, _, test = _split_fit(data, ml.classifier(kind, **params))
    accuracy = ml.accuracy(model.transform(test))
    return model.transform(data).select(
        "doc_id", "label", "prediction", vector_to_array("probability")[1].alias("probability"),
        F.lit(accuracy).alias("test_accuracy"))


LOGREG = {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5}


def logreg(spark, sf_dir):
    return _classify("logistic", spark, sf_dir, **LOGREG)


def random_forest(spark, sf_dir):
    return _classify("forest", spark, sf_dir)


def gbt(spark, sf_dir):
    return _classify("gbt", spark, sf_dir)


ORDER_COLS = ["qty", "gross", "n_lines"]


def _order_vectors(spark, sf_dir):
    t = _t(spark, sf_dir)
    lines = (t.lineitem.groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("gross"),
                  F.count(F.lit(1)).cast("double").alias("n_lines")))
    o = t.orders.select("o_orderkey", F.col("o_totalprice").alias("label"))
    return ml.assemble(lines.join(o, lines["l_orderkey"] == o["o_orderkey"]), ORDER_COLS)


def linreg(spark, sf_dir):
    """Order totals from their lines: fitted on a seeded 80 % split, with the RMSE on the rest."""
    data = _order_vectors(spark, sf_dir)
    model, _, test = _split_fit(data, ml.linear_regression())
    error = ml.rmse(model.transform(test))
    return model.transform(data).select("o_orderkey", "prediction", F.lit(error).alias("test_rmse"))


# ------------------------------------------- labelled vectors (embeddings)

def _vectors(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector
    e = _t(spark, sf_dir).embeddings
    return e.select("vec_id", array_to_vector("embedding").alias("features"),
                    F.col("label").cast("double").alias("label"))


def vector_elbow(spark, sf_dir):
    """Elbow sweep k = 2..6 with cosine distance: cost and silhouette per k."""
    return _elbow_rows(spark, ml.elbow(_vectors(spark, sf_dir), range(2, 7), max_iter=50, distance="cosine"))


def _vector_logreg(spark, sf_dir):
    data = ml.std_scale(_vectors(spark, sf_dir), out="scaled")
    return data, ml.classifier("logistic", features="scaled", family="multinomial", maxIter=20,
                               regParam=0.0).fit(data)


def vector_logreg_multinomial(spark, sf_dir):
    """Standard scaling (std only) then multinomial logistic regression."""
    data, model = _vector_logreg(spark, sf_dir)
    return model.transform(data).select("vec_id", "prediction")


def vector_cluster_contingency(spark, sf_dir):
    """KMeans with one cluster per label, then the label x cluster table:
    one row per label, one count column per cluster (0 when empty)."""
    data = _vectors(spark, sf_dir)
    k = data.select("label").distinct().count()
    pred = ml.kmeans(data, k, max_iter=20).transform(data)
    table = pred.groupBy("label").pivot("prediction", list(range(k))).agg(F.count(F.lit(1)))
    return table.select("label", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"cluster_{c}")
                                   for c in range(k)])


VECTOR_TREE = {"impurity": "entropy", "maxDepth": 5, "maxBins": 32}


def vector_tree(spark, sf_dir):
    """Decision tree (entropy, depth 5, 32 bins) on a seeded 80 % split."""
    data = _vectors(spark, sf_dir)
    model, _, test = _split_fit(data, ml.classifier("tree", **VECTOR_TREE))
    accuracy = ml.accuracy(model.transform(test))
    return model.transform(data).select("vec_id", "prediction", F.lit(accuracy).alias("test_accuracy"))


# ------------------------------------------------------ feature transforms

def _acct(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return ml.assemble(c, ["c_acctbal"])


def minmax_scale(spark, sf_dir):
    s = ml.min_max_scale(_acct(spark, sf_dir))
    return s.select("c_custkey", F.round(vector_to_array("scaled")[0], 9).alias("acctbal_scaled"))


def standard_scale(spark, sf_dir):
    s = ml.std_scale(_acct(spark, sf_dir))
    return s.select("c_custkey", F.round(vector_to_array("scaled")[0], 9).alias("acctbal_std"))


def _indexed(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    return StringIndexer(inputCol="c_mktsegment", outputCol="seg_index",
                         stringOrderType="frequencyDesc").fit(c).transform(c)


def string_index(spark, sf_dir):
    return _indexed(spark, sf_dir).select("c_custkey", "seg_index")


def one_hot(spark, sf_dir):
    i = _indexed(spark, sf_dir)
    o = OneHotEncoder(inputCol="seg_index", outputCol="seg_vec", dropLast=False).fit(i).transform(i)
    bits = F.transform(vector_to_array("seg_vec"), lambda x: x.cast("int").cast("string"))
    return o.select("c_custkey", F.array_join(bits, ",").alias("seg_onehot"))


# ------------------------------------------------------------ certificates

def rfm_certificate(spark, sf_dir):
    return certify.clusters(_rfm_fit(spark, sf_dir, sweep=None), _rfm_tags(spark))


def rfm_scaled_certificate(spark, sf_dir):
    return certify.clusters(_rfm_scaled_fit(spark, sf_dir), _rfm_tags(spark))


def rfe_certificate(spark, sf_dir):
    return certify.clusters(_rfe_fit(spark, sf_dir), _rfe_tags(spark))


def psm_certificate(spark, sf_dir):
    return certify.clusters(_psm_fit(spark, sf_dir), _psm_tags(spark))


def als_implicit_certificate(spark, sf_dir):
    logs, columns = _clicks(spark, sf_dir)
    m = models.preference_model(logs, measure=True, **columns)
    # predicted preferences lie about 0 to 1: next to the clicks, the error is at most their size
    sane = (F.lit(m.rmse) > 0) & (F.lit(m.rmse) <= F.sqrt(F.avg(F.col("r") * F.col("r"))))
    return certify.factors(m, reg=1.0, implicit=True).join(m.ratings.agg(sane.alias("rmse_within_clicks")))


def als_explicit_certificate(spark, sf_dir):
    return certify.factors(_rating_model(spark, sf_dir), reg=0.1, implicit=False)


def usg_tree_certificate(spark, sf_dir):
    """The tree search: settings and folds tried, the rows of each fold, the winner's score,
    and the final tree replayed on all (counted) lines it was fitted to."""
    search = models.usg_search(shop.labelled_lines(_t(spark, sf_dir)), categorical=["brand", "ptype"],
                               fold=_line_fold())
    folds = search.rows.groupBy().pivot("fold", [0, 1, 2]).agg(F.sum("weight").cast("long"))
    tree = search.pipeline.stages[-1]
    cert = certify.trees(tree, search.rows, search.rows, weight="weight")
    best = search.scores[search.settings.index(search.best)]
    return cert.join(folds.select(*[F.col(str(k)).alias(f"n_fold_{k}") for k in range(3)])).select(
        "*", F.lit(len(search.settings)).cast("long").alias("n_settings"), F.lit(best == max(search.scores)).alias("best_wins"))


def vector_tree_certificate(spark, sf_dir):
    data = _vectors(spark, sf_dir)
    model, train, _ = _split_fit(data, ml.classifier("tree", **VECTOR_TREE))
    return certify.trees(model, data, train)


def _forest_certificate(kind, spark, sf_dir):
    data = _doc_features(spark, sf_dir)
    return certify.trees(_split_fit(data, ml.classifier(kind))[0], data)


def random_forest_certificate(spark, sf_dir):
    return _forest_certificate("forest", spark, sf_dir)


def gbt_certificate(spark, sf_dir):
    return _forest_certificate("gbt", spark, sf_dir)


def logreg_certificate(spark, sf_dir):
    data = _doc_features(spark, sf_dir)
    model, train, _ = _split_fit(data, ml.classifier("logistic", **LOGREG))
    return certify.logistic(model, data, train)


def vector_logreg_certificate(spark, sf_dir):
    data, model = _vector_logreg(spark, sf_dir)
    return certify.logistic(model, data, data, features="scaled")


def linreg_certificate(spark, sf_dir):
    data = _order_vectors(spark, sf_dir)
    model, train, _ = _split_fit(data, ml.linear_regression())
    return certify.linear(model, data, train)


CERTIFICATES = [rfm_certificate, rfm_scaled_certificate, rfe_certificate, psm_certificate, als_implicit_certificate,
                als_explicit_certificate, usg_tree_certificate, vector_tree_certificate, random_forest_certificate,
                gbt_certificate, logreg_certificate, vector_logreg_certificate, linreg_certificate]

QUERIES = {
    "minmax_scale": minmax_scale, "standard_scale": standard_scale,
    "string_index": string_index, "one_hot": one_hot,
    "rfm_kmeans": rfm_kmeans, "rfm_scaled_kmeans": rfm_scaled_kmeans,
    "als_explicit_rmse": als_explicit_rmse, "als_explicit_top5_items": als_explicit_top5_items,
    "rfe_kmeans": rfe_kmeans, "psm_kmeans": psm_kmeans,
    "elbow": elbow, "usg_tree": usg_tree, "bp_als_top5": bp_als_top5,
    "als_explicit_top5": als_explicit_top5, "logreg": logreg, "linreg": linreg,
    "random_forest": random_forest, "gbt": gbt,
    "vector_elbow": vector_elbow, "vector_logreg_multinomial": vector_logreg_multinomial,
    "vector_cluster_contingency": vector_cluster_contingency, "vector_tree": vector_tree,
} | {q.__name__: q for q in CERTIFICATES}
