"""Tag models: each takes business DataFrames and the tag's catalog rows and
returns ``(userId, <tag column>)``; ``run_tag_model`` is the template that
fetches the tag, reads its data from the rule, computes and saves.

Rule models (exact value, range, most frequent) are joins; statistics models
add one aggregation; mining models add a Spark ML fit whose clusters are
named by rank, so the labels do not depend on cluster numbering.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import MinMaxScaler, StringIndexer
from pyspark.ml.recommendation import ALSModel
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scoring import (RFE_ENGAGEMENT, RFE_FREQUENCY, RFE_RECENCY,
                                       RFE_RECENCY_SHIFT_DAYS, RFM_FREQUENCY, RFM_MONETARY,
                                       RFM_RECENCY)
from kestrel.functions.text import date_to_int, url_to_product
from kestrel.operators import catalog as cat
from kestrel.operators import match, measures, ml, topn
from kestrel.operators.profile import ProfileStore, recommendations_to_strings
from kestrel.sources.meta import parse_rule, read_source

RFM_TABLES = {"recency": RFM_RECENCY, "frequency": RFM_FREQUENCY, "monetary": RFM_MONETARY}
RFE_TABLES = {"recency": RFE_RECENCY, "frequency": RFE_FREQUENCY, "engagements": RFE_ENGAGEMENT}


# ------------------------------------------------------------------ rules

def match_tag(biz: DataFrame, tags: DataFrame, field: str, *, key: str = "id",
              out: str | None = None, on_unmatched: str = "drop") -> DataFrame:
    """Gender, job, nationality, political status: value -> attribute tag."""
    return match.rule_match(biz, field, tags, key=key, out=out or field, on_unmatched=on_unmatched)


def age_band_tag(biz: DataFrame, tags: DataFrame, *, key: str = "id", birthday: str = "birthday",
                 out: str = "agerange") -> DataFrame:
    """``yyyy-MM-dd`` birthday -> yyyyMMdd int -> the range tag holding it."""
    return match.range_match(biz, date_to_int(F.col(birthday)), tags, key=key, out=out)


def consume_cycle_tag(orders: DataFrame, tags: DataFrame, *, user: str = "memberid",
                      finish_epoch: str = "finishtime", as_of=None, out: str = "consumecycle",
                      on_unmatched: str = "drop", tz: str | None = None) -> DataFrame:
    """Days since the latest finished order (epoch seconds) -> range tag.

    The epoch is read in the session zone unless ``tz`` names one."""
    from kestrel.functions.dates import as_of_date, epoch_to_date
    last = orders.groupBy(F.col(user).alias("__u")).agg(
        F.max(F.col(finish_epoch).try_cast("long")).alias("__t"))
    days = F.datediff(as_of_date(as_of), epoch_to_date(F.col("__t"), tz))
    return match.range_match(last, days, tags, key="__u", out=out, on_unmatched=on_unmatched)


def pay_type_tag(orders: DataFrame, tags: DataFrame, *, user: str = "memberid",
                 code: str = "paymentcode", out: str = "paymenttype") -> DataFrame:
    top = measures.most_frequent(orders, user=user, value=code, out="__code")
    return match.rule_match(top, "__code", tags, key="userId", out=out)


# ----------------------------------------------------------------- mining

@dataclass
class ClusterFit:
    """Users' vectors, the clusters fitted to them, and the users without a vector."""

    model: KMeansModel
    data: DataFrame          # userId and the vector column ``features``
    features: str
    missing: DataFrame       # userId of users with a null measure

    def scored(self) -> DataFrame:
        return self.model.transform(self.data)

    def tagged(self, tags: DataFrame, out: str) -> DataFrame:
        """``(userId, out)``: each cluster named by the rank of its centre."""
        named = match.label_by_rank(self.scored(), ml.rank_centers(self.model), tags, out=out)
        return named.unionByName(self.missing.select("userId", F.lit(None).cast("string").alias(out)))


def cluster_users(features_df: DataFrame, cols: list[str], k: int, *, scale: bool = False,
                  sweep=ml.KMEANS_SWEEP_ITERS, null_policy: str = "keep", store: ml.ModelStore | None = None,
                  model_name: str = "clusters", retrain: bool = False, max_iter: int = 20) -> ClusterFit:
    """Cluster users on ``cols``.

    ``sweep``: the iteration bounds to fit with (True: the usual ones), of which the
    cheapest fit is kept; empty or None fits once with ``max_iter``.  ``scale``: min-max scaling
    first.  ``null_policy``: a user with a null measure is left out of the clusters
    (``keep``: and gets a null tag) or fails the job (``error``).
    """
    if null_policy not in ("keep", "error"):
        raise ValueError("null_policy must be 'keep' or 'error'")
    rows = features_df.select("userId", *cols)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    known = rows.where(~missing) if null_policy == "keep" else rows
    data = ml.assemble(known, cols, "raw", handle_invalid="error")
    # The per-user vectors feed the fit and the final scoring: compute them
    # once (one row per user, far smaller than the business rows behind them)
    # and cut the lineage in the shared checkpoint folder.
    from kestrel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(data.sparkSession)
    data = data.checkpoint()
    feat = "raw"
    if scale:
        data = MinMaxScaler(inputCol="raw", outputCol="scaled").fit(data).transform(data)
        feat = "scaled"

    def train():
        if sweep:
            iters = ml.KMEANS_SWEEP_ITERS if sweep is True else tuple(sweep)
            return ml.kmeans_sweep(data, k, iters=iters, features=feat)
        return ml.kmeans(data, k, max_iter=max_iter, features=feat)

    model = store.load_or_train(model_name, KMeansModel, train, retrain) if store is not None else train()
    left = rows.where(missing) if null_policy == "keep" else rows.limit(0)
    return ClusterFit(model, data, feat, left.select("userId"))


def kmeans_tag(features_df: DataFrame, cols: list[str], tags: DataFrame, k: int, *, out: str,
               model_name: str | None = None, **kw) -> DataFrame:
    """Cluster users on ``cols`` (see :func:`cluster_users`) and name each cluster by the
    rank of its centre (largest coordinate sum = rank 0 = rule ``"0"``)."""
    return cluster_users(features_df, cols, k, model_name=model_name or out, **kw).tagged(tags, out)


def rfm_tag(orders: DataFrame, tags: DataFrame, *, user="memberid", order_id="ordersn",
            amount="orderamount", ts=None, finish_epoch="finishtime", as_of=None,
            tables=RFM_TABLES, strict: bool = False, k: int = 5, **kw) -> DataFrame:
    if ts is None:
        orders = orders.withColumn("__ts", F.from_unixtime(F.col(finish_epoch).try_cast("long")))
        ts = "__ts"
    m = measures.rfm_measures(orders, user=user, order_id=order_id, amount=amount, ts=ts, as_of=as_of)
    scores = measures.score_measures(m, tables, strict)
    return kmeans_tag(scores, ["r_score", "f_score", "m_score"], tags, k, out=kw.pop("out", "rfm"), **kw)


def rfe_tag(logs: DataFrame, tags: DataFrame, *, user="global_user_id", ts="log_time",
            page="loc_url", as_of=None, shift_days=RFE_RECENCY_SHIFT_DAYS, tables=RFE_TABLES,
            strict: bool = False, k: int = 4, recency_ts=None, **kw) -> DataFrame:
    m = measures.rfe_measures(logs, user=user, ts=ts, page=page, as_of=as_of,
                              shift_days=shift_days, recency_ts=recency_ts)
    scores = measures.score_measures(m, tables, strict)
    return kmeans_tag(scores, ["r_score", "f_score", "e_score"], tags, k, out=kw.pop("out", "rfe"), **kw)


def psm_tag(lines: DataFrame, tags: DataFrame, *, user, order_id, amount, coupon, k: int = 5,
            **kw) -> DataFrame:
    p = measures.psm_measures(lines, user=user, order_id=order_id, amount=amount, coupon=coupon)
    return kmeans_tag(p, ["psm"], tags, k, out=kw.pop("out", "psm"), **kw)


def usg_rule_tag(labelled: DataFrame, tags: DataFrame, *, out: str = "usg",
                 share: float = measures.GENDER_SHARE) -> DataFrame:
    """Purchase gender from 0/1 line labels: share >= ``share`` decides."""
    c = measures.share_counts(labelled)
    coded = c.select("userId", measures.share_rule(F.col("total"), F.col("male_total"),
                                                   F.col("female_total"), share).alias("__rule"))
    return match.rule_match(coded, "__rule", tags, key="userId", out=out)


def usg_search(lines: DataFrame, *, categorical: list[str], label: str = "label", folds: int = 3,
               fold: Column | None = None, seed: int = ml.KMEANS_SEED) -> ml.TreeSearch:
    """The search behind :func:`usg_learned_tag`.

    Lines of one fold, one label and the same goods are alike to a tree, so they are
    counted first: the indexers, the vectors and all fits work on one weighted row for
    each such combination, however many lines there are.  ``fold`` gives a line's fold
    from 0 on; by default a hash of the line's columns.
    """
    fold = F.pmod(F.xxhash64(F.lit(seed), *lines.columns), F.lit(folds)) if fold is None else fold
    from kestrel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(lines.sparkSession)
    counted = (lines.select(*categorical, F.col(label).cast("double").alias(label), fold.cast("int").alias("fold"))
               .groupBy(*categorical, label, "fold").agg(F.count(F.lit(1)).cast("double").alias("weight"))).checkpoint()
    indexed = [f"{c}_idx" for c in categorical]
    prepare = Pipeline(stages=[
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        *ml.tree_pipeline(indexed, label=label).getStages()[:-1]])
    return ml.search_trees(prepare, counted, label=label, weight="weight", fold="fold", folds=folds, seed=seed)


def usg_learned_tag(lines: DataFrame, tags: DataFrame, *, categorical: list[str],
                    label: str = "label", out: str = "usg", folds: int = 3, fold: Column | None = None,
                    seed: int = ml.KMEANS_SEED, store: ml.ModelStore | None = None,
                    retrain: bool = False) -> DataFrame:
    """Purchase gender with line labels predicted by a cross-validated tree.

    Categorical goods attributes are indexed, assembled, vector-indexed (up to 30
    categories) and fed to a decision tree; a 3-fold search over impurity x depth
    (5, 10) x bins (32, 64) whose folds are drawn over the lines; the fitted
    pipeline labels every line, then the share rule names each user.
    """
    def train():
        return usg_search(lines, categorical=categorical, label=label, folds=folds, fold=fold, seed=seed).pipeline

    from pyspark.ml import PipelineModel
    model = store.load_or_train("usg_tree", PipelineModel, train, retrain) if store else train()
    pred = model.transform(lines).select("userId", F.col("prediction").cast("int").alias("label"))
    return usg_rule_tag(pred, tags, out=out)


def _factorised(ratings: DataFrame, *, user: str, item: str, rating: str):
    """Ratings with 32-bit ids, and the two id maps.  Rows with a null are left out.

    The rows are read by the id maps and by every pass of the fit: they are computed once,
    into the shared checkpoint folder.
    """
    from kestrel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(ratings.sparkSession)
    data = ratings.select(F.col(user).alias("__user"), F.col(item).alias("__item"),
                          F.col(rating).cast("float").alias("r")).dropna().checkpoint()
    data, umap = ml.int_ids(data, "__user", "uid")
    data, imap = ml.int_ids(data, "__item", "iid")
    return data.select("uid", "iid", "r").checkpoint(), umap, imap


@dataclass
class RatingModel:
    """A fitted ALS with its id maps, the ratings it was fitted to (ids as in the maps; None
    once loaded) and, where measured, its RMSE."""

    model: ALSModel
    rmse: float | None
    users: DataFrame
    items: DataFrame
    ratings: DataFrame | None = None

    def factors(self, side: str) -> DataFrame:
        """``(id, features)`` of ``side`` ``users`` or ``items``, with original ids."""
        rows, ids, name = ((self.model.userFactors, self.users, "uid") if side == "users"
                           else (self.model.itemFactors, self.items, "iid"))
        key = [c for c in ids.columns if c != name][0]
        return rows.withColumnRenamed("id", name).join(ids, name).select(F.col(key).alias("id"), "features")

    def top(self, side: str, n: int, some: DataFrame | None = None) -> DataFrame:
        """``(id, recommendations)``: the best ``n`` of the other side for every row of
        ``side``, or for those whose id is in ``some`` (its only column)."""
        of = self.factors(side)
        if some is not None:
            of = of.join(some.toDF("id").distinct(), "id", "left_semi")
        return topn.top_n(of, self.factors("items" if side == "users" else "users"), n)

    def training_rmse(self) -> float:
        """RMSE over the ratings that the model was fitted to."""
        return ml.rmse(self.model.transform(self.ratings), label="r")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")
        self.users.sparkSession.createDataFrame([(self.rmse,)], "rmse double").write.mode(
            "overwrite").parquet(f"{path}/rmse")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RatingModel":
        return cls(ALSModel.load(f"{path}/model"), spark.read.parquet(f"{path}/rmse").first()["rmse"],
                   spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"))


def preference_model(logs: DataFrame, *, user: str = "global_user_id", url: str = "loc_url",
                     item: Column | None = None, rank: int = 10, max_iter: int = 10, reg: float = 1.0,
                     alpha: float = 1.0, measure: bool = False) -> RatingModel:
    """Implicit ALS on the clicks per (user, item).

    Item ids come from the URL (``url_to_product``) unless ``item`` is given.  Users and
    items may be strings or numbers; null ones are left out.  ``measure`` computes the
    RMSE of predicted preferences against the clicks they were fitted to.
    """
    it = item if item is not None else url_to_product(F.col(url))
    clicks = (logs.select(F.col(user).alias("__user"), it.alias("__item"))
              .where(F.col("__user").isNotNull() & F.col("__item").isNotNull())
              .groupBy("__user", "__item").agg(F.count(F.lit(1)).alias("clicks")))
    data, umap, imap = _factorised(clicks, user="__user", item="__item", rating="clicks")
    model = ml.als(True, user="uid", item="iid", rating="r", rank=rank, max_iter=max_iter,
                   reg=reg, alpha=alpha).fit(data)
    fitted = RatingModel(model, None, umap, imap, data)
    if measure:
        fitted.rmse = fitted.training_rmse()
    return fitted


def preference_tag(logs: DataFrame, *, top_n: int = 5, users: DataFrame | None = None, **kw) -> DataFrame:
    """Item preference: the top-N items per user of a :func:`preference_model` as
    comma-joined ``productIds`` / ``ratings``; for all users or those in ``users``
    (one column of ids)."""
    recs = preference_model(logs, **kw).top("users", top_n, users)
    return recommendations_to_strings(recs, user="id", item="id")


def rating_model(ratings: DataFrame, *, user: str, item: str, rating: str, rank: int = 10,
                 max_iter: int = 10, reg: float = 0.1, train_ratio: float = 0.8,
                 seed: int = ml.KMEANS_SEED, measure: bool = True) -> RatingModel:
    """Explicit-rating ALS on all ratings, so every user and item has factors.

    With ``measure`` another model, fitted on a seeded ``train_ratio`` of the ratings,
    predicts the others: predictions are joined to the actual ratings on (user, item) and
    give the RMSE.  Ids are of any type; rows with a null id or rating are left out.
    """
    data, umap, imap = _factorised(ratings, user=user, item=item, rating=rating)
    est = ml.als(False, user="uid", item="iid", rating="r", rank=rank, max_iter=max_iter,
                 reg=reg, seed=seed)
    err = None
    if measure:
        train, test = data.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
        pred = est.fit(train).transform(test.select("uid", "iid")).withColumnRenamed("prediction", "p")
        scored = pred.join(test, ["uid", "iid"])
        err = ml.rmse(scored, label="r", prediction="p") if scored.take(1) else float("nan")
    return RatingModel(est.fit(data), err, umap, imap, data)


def _listed(recs: DataFrame, of_name: str, other_name: str) -> DataFrame:
    return recs.select(
        F.col("id").alias(of_name),
        F.array_join(F.transform("recommendations", lambda r: r["id"].cast("string")), ",").alias(other_name),
        F.array_join(F.transform("recommendations", lambda r: F.round(r["rating"], 4).cast("string")),
                     ",").alias("ratings"))


def top_users_per_item(m: RatingModel, n: int, items: DataFrame | None = None) -> DataFrame:
    """``(itemId, userIds, ratings)``: the best ``n`` users of every item, or of those in
    ``items`` (column itemId)."""
    return _listed(m.top("items", n, items), "itemId", "userIds")


def top_items_per_user(m: RatingModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """``(userId, itemIds, ratings)``: the best ``n`` items of every user, or of those in
    ``users`` (column userId)."""
    return _listed(m.top("users", n, users), "userId", "itemIds")


# --------------------------------------------------------------- template

def run_tag_model(spark: SparkSession, catalog: DataFrame, tag_id: int, compute, *,
                  store: ProfileStore | None = None, as_of=None, base: str | None = None) -> DataFrame:
    """Template: tag rows -> rule -> business data -> compute -> save.

    ``compute(business_df, tag_df)`` returns ``(userId, <tag>)``; when a
    ``store`` is given the result is upserted into the profile.
    """
    tags = cat.fetch_tag(catalog, tag_id)
    rule = parse_rule(tags)
    if base and rule.get("table") and not rule.get("path"):
        rule = {**rule, "path": f"{base.rstrip('/')}/{rule['table']}.parquet"}
    biz = read_source(spark, rule, as_of=as_of)
    result = compute(biz, tags)
    if store is not None:
        store.save(result)
    return result

