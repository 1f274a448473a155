"""Certificates of fitted models: one row each, computed from the model's own parameters.

A certificate does not fit anything again.  It tests, over all rows, what makes a set of
parameters the model it claims to be: centres that are the means of the users nearest to
them, factors that solve their normal equations, trees whose nodes, replayed as ``CASE``
expressions, give the predictions and the majorities of their leaves, coefficients at
which the gradient vanishes.  Parameters (centres, nodes, coefficients: bounded by the
model's settings) become literals; factors stay tables and are joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-6     # relative, for sums of doubles
FLOAT_TOLERANCE = 1e-3   # relative, for sums over single-precision factors


def _literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _distance(a: Column, centre) -> Column:
    return F.aggregate(F.zip_with(a, _literal(centre), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


# ---------------------------------------------------------------- clusters

def clusters(fit, tags: DataFrame, out: str = "tag") -> DataFrame:
    """Certificate of a :class:`ClusterFit` and of the tags it gives.

    ``n_users``, ``n_untagged`` (a null measure); ``n_not_nearest`` users in another cluster
    than that of the nearest centre; ``n_mistagged`` users whose tag is not that of their
    centre's rank; ``centres_are_means``; ``cost_adds_up`` (the fit's cost, if it is known);
    ``coordinate_sum``: cluster sizes times centres, which is the sum of all measures.
    """
    centres = [[float(x) for x in c] for c in fit.model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda c: (-sum(centres[c]), c))
    rank = F.create_map(*[F.lit(x) for r, c in enumerate(order) for x in (c, str(r))])
    a = vector_to_array(fit.features)
    rows = fit.scored().select("userId", "prediction", a.alias("a"))
    rows = rows.withColumn("d", F.array(*[_distance(F.col("a"), c) for c in centres]))
    rows = rows.withColumn("own", F.col("d")[F.col("prediction")])
    named = fit.tagged(tags, "__tag")
    rules = tags.where((F.col("level") == 5) & F.col("rule").isNotNull()).groupBy("rule").agg(F.min("name").alias("__name"))
    expected = (rows.select("userId", rank[F.col("prediction")].alias("rule")).join(rules, "rule", "left")
                .select("userId", "__name"))
    wrong = (named.join(expected, "userId", "left")
             .agg(F.count(F.lit(1)).alias("n_users"), F.count_if(F.col("__tag").isNull()).alias("n_untagged"),
                  F.count_if(~F.col("__tag").eqNullSafe(F.col("__name"))).alias("n_mistagged")))
    size = len(centres[0])
    means = rows.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum("own").alias("cost"),
        F.count_if(F.col("own") > F.array_min("d") * (1 + TOLERANCE) + TOLERANCE).alias("away"),
        *[F.avg(F.col("a")[j]).alias(f"m{j}") for j in range(size)])
    centre = F.array(*[_literal(c) for c in centres])[F.col("prediction")]
    gap = F.greatest(*[F.abs(F.col(f"m{j}") - centre[j]) for j in range(size)], F.lit(0.0))
    total = F.aggregate(centre, F.lit(0.0), lambda s, x: s + x) * F.col("n")
    known = fit.model.summary.trainingCost if fit.model.hasSummary else None
    cost = F.sum("cost")
    checked = means.agg(
        F.sum("away").alias("n_not_nearest"), (F.max(gap) <= TOLERANCE).alias("centres_are_means"),
        (F.lit(True) if known is None else F.abs(cost - known) <= TOLERANCE * (1 + abs(known))).alias("cost_adds_up"),
        F.round(F.sum(total), 3).alias("coordinate_sum"))
    return wrong.join(checked)


# ----------------------------------------------------------------- factors

def factors(m, *, reg: float, implicit: bool, alpha: float = 1.0, n: int = 5) -> DataFrame:
    """Certificate of a :class:`RatingModel`'s factors and of its top-``n`` lists.

    The users' factors are solved last: each solves the normal equations of its user's
    ratings against the items' factors.  ``n_unsolved`` counts the users with a residual
    beyond rounding.  ``n_lists_off`` counts the users whose list differs from that of
    Spark's own product over all pairs by more than rounding.
    """
    rank = m.model.rank
    users = m.model.userFactors.select(F.col("id").alias("uid"), F.col("features").cast("array<double>").alias("x"))
    items = m.model.itemFactors.select(F.col("id").alias("iid"), F.col("features").cast("array<double>").alias("y"))
    rows = m.ratings.select("uid", "iid", F.col("r").cast("double").alias("r")).join(users, "uid").join(items, "iid")
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    if implicit:
        # sum over rated items of c1 (y.x) y - (1 + c1) [r > 0] y, beside YtY x for all items
        c1 = F.abs("r") * alpha
        weight = c1 * dot - F.when(F.col("r") > 0, 1 + c1).otherwise(0.0)
        right = F.when(F.col("r") > 0, 1 + c1).otherwise(0.0)
        counted = F.col("r") > 0
    else:
        weight, right, counted = dot - F.col("r"), F.col("r"), F.lit(True)
    rows = rows.withColumn("w", weight).withColumn("b", right)
    sums = rows.groupBy("uid").agg(
        F.count_if(counted).alias("n"),
        F.array(*[F.sum(F.col("w") * F.col("y")[j]) for j in range(rank)]).alias("residual"),
        F.array(*[F.sum(F.abs(F.col("b") * F.col("y")[j])) for j in range(rank)]).alias("scale"))
    solved = sums.join(users, "uid")
    if implicit:
        gram = items.agg(*[F.sum(F.col("y")[a] * F.col("y")[b]).alias(f"g{a}_{b}")
                           for a in range(rank) for b in range(a, rank)]).first()     # rank x rank numbers
        g = [[float(gram[f"g{min(a, b)}_{max(a, b)}"] or 0) for b in range(rank)] for a in range(rank)]
        base = F.array(*[F.aggregate(F.zip_with("x", _literal(row), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
                         for row in g])
    else:
        base = F.transform("x", lambda v: F.lit(0.0))
    left = F.array(*[F.abs(F.col("residual")[j] + F.col("base")[j] + reg * F.col("n") * F.col("x")[j]) for j in range(rank)])
    solved = solved.withColumn("base", base)
    worst = F.array_max(left) / (1e-9 + F.array_max("scale"))
    tested = solved.agg(F.count(F.lit(1)).alias("n_users"), F.count_if(worst > FLOAT_TOLERANCE).alias("n_unsolved"))
    size = m.ratings.agg(F.count(F.lit(1)).alias("n_ratings"), F.countDistinct("iid").alias("n_items"))

    own = m.top("users", n)
    key = [c for c in m.users.columns if c != "uid"][0]
    theirs = m.model.recommendForAllUsers(n).join(m.users, "uid").select(
        F.col(key).alias("id"), F.transform("recommendations", lambda r: r["rating"]).alias("theirs"))
    pairs = F.zip_with(F.transform("recommendations", lambda r: r["rating"]), "theirs",
                       lambda a, b: F.coalesce(F.abs(a - b) > 1e-4 * (1 + F.abs(b)), F.lit(True)))
    lists = own.join(theirs, "id", "full_outer").agg(
        F.count_if(F.coalesce(F.exists(pairs, lambda x: x), F.lit(True))).alias("n_lists_off"),
        F.sum(F.size("recommendations")).cast("long").alias("n_recommended"))
    return tested.join(size).join(lists)


# ------------------------------------------------------------------- trees

def _case(node, leaf) -> str:
    """A tree's nodes as nested ``CASE`` over the array ``f``."""
    if node.numDescendants() == 0:
        return leaf(node)
    split = node.split()
    at = f"f[{split.featureIndex()}]"
    if split.getClass().getSimpleName() == "CategoricalSplit":
        left = [repr(float(x)) + "D" for x in split.leftCategories()]
        test = f"{at} IN ({', '.join(left)})" if left else "false"
    else:
        test = f"{at} <= {float(split.threshold())!r}D"
    return f"CASE WHEN {test} THEN {_case(node.leftChild(), leaf)} ELSE {_case(node.rightChild(), leaf)} END"


def _prediction(node) -> str:
    return f"{float(node.prediction())!r}D"


def _share(node) -> str:
    """The share of class 1 among a leaf's rows (two classes)."""
    stats = [float(x) for x in node.impurityStats().stats()]
    return f"{(stats[1] / sum(stats) if sum(stats) else 0.0)!r}D"


def replayed(model, features: str = "features") -> Column:
    """The prediction of a decision tree, or of a forest or boosted trees of two classes,
    from its nodes alone; for rows that have the vector as an array ``f``."""
    java = model._java_obj
    if not hasattr(model, "trees"):
        return F.expr(_case(java.rootNode(), _prediction))
    trees, weights = list(java.trees()), list(java.treeWeights())
    if "GBT" in type(model).__name__:
        votes = [f"({w!r}D * {_case(t.rootNode(), _prediction)})" for t, w in zip(trees, weights)]
        return F.when(reduce(lambda a, b: a + b, [F.expr(v) for v in votes]) > 0, 1.0).otherwise(0.0)
    share = reduce(lambda a, b: a + b, [F.expr(_case(t.rootNode(), _share)) for t in trees]) / len(trees)
    return F.when(share > 0.5, 1.0).otherwise(0.0)


def _leaves(model) -> Column:
    """A number for each leaf of a decision tree."""
    count = iter(range(1 << 30))
    return F.expr(_case(model._java_obj.rootNode(), lambda node: str(next(count))))


def trees(model, data: DataFrame, train: DataFrame | None = None, *, label: str = "label",
          weight: str | None = None) -> DataFrame:
    """Certificate of a tree model on ``data``: ``n_rows``, ``n_labelled_1`` and
    ``n_replayed_off``, rows where the nodes give another prediction than the model (a forest
    vote within rounding of one half is no difference).

    With the rows a single tree was fitted to, ``train``: ``n_leaves_off``, leaves that
    do not predict the majority of their rows.
    """
    n = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = model.transform(data).withColumn("f", vector_to_array("features"))
    off = F.col("prediction") != replayed(model)
    if not hasattr(model, "trees"):
        pass
    elif "GBT" not in type(model).__name__:
        p = vector_to_array("probability")
        off = off & (F.abs(p[1] - 0.5) > 1e-9)
    out = rows.agg(F.sum(n).cast("long").alias("n_rows"),
                   F.coalesce(F.sum(F.when(F.col(label) == 1, n)), F.lit(0.0)).cast("long").alias("n_labelled_1"),
                   F.count_if(off).alias("n_replayed_off"))
    if train is None:
        return out
    placed = (model.transform(train).withColumn("f", vector_to_array("features"))
              .select(_leaves(model).alias("leaf"), "prediction", F.col(label).alias("label"), n.alias("n")))
    votes = placed.groupBy("leaf", "prediction", "label").agg(F.sum("n").alias("n"))
    best = votes.groupBy("leaf").agg(F.max("n").alias("best"), F.max(
        F.when(F.col("label") == F.col("prediction"), F.col("n"))).alias("own"))
    return out.join(best.agg(F.count_if(F.coalesce(F.col("own"), F.lit(0.0)) < F.col("best")).alias("n_leaves_off")))


# ------------------------------------------------------------ coefficients

def logistic(model, data: DataFrame, train: DataFrame, *, label: str = "label", features: str = "features") -> DataFrame:
    """Certificate of a logistic regression: ``n_rows``, ``n_replayed_off`` (rows whose
    probabilities are not those of the coefficients), and ``no_worse_than_constant``: no
    greater log-loss on the rows fitted to than the shares of their labels give, which is
    where the fit starts from."""
    k = model.numClasses
    matrix, cut = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
    if len(matrix) == 1 and k == 2:                      # binomial: one row for class 1
        matrix, cut = [[0.0] * len(matrix[0]), matrix[0]], [0.0, cut[0]]
    margins = F.array(*[F.aggregate(F.zip_with("f", _literal(row), lambda a, b: a * b), F.lit(b), lambda s, v: s + v)
                        for row, b in zip(matrix, cut)])

    def with_p(df):
        rows = df.withColumn("f", vector_to_array(features)).withColumn("margins", margins)
        rows = rows.withColumn("e", F.transform("margins", lambda m: F.exp(m - F.array_max("margins"))))
        total = F.aggregate("e", F.lit(0.0), lambda s, v: s + v)
        return rows.withColumn("p", F.transform("e", lambda v: v / total))

    scored = with_p(model.transform(data))
    gap = F.array_max(F.zip_with("p", vector_to_array("probability"), lambda a, b: F.abs(a - b)))
    out = scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(gap > 1e-9).alias("n_replayed_off"))
    fitted = with_p(train)
    own = fitted.agg(F.avg(-F.log(F.greatest(F.col("p")[F.col(label).cast("int")], F.lit(1e-300)))).alias("loss"))
    shares = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        (F.sum(-F.col("n") * F.log("n")) / F.sum("n") + F.log(F.sum("n"))).alias("entropy"))
    return out.join(own.join(shares).select((F.col("loss") <= F.col("entropy") * (1 + TOLERANCE) + TOLERANCE).alias(
        "no_worse_than_constant")))


def linear(model, data: DataFrame, train: DataFrame, *, label: str = "label", features: str = "features") -> DataFrame:
    """Certificate of a linear regression: ``n_rows``, ``n_replayed_off`` (predictions that
    are not those of the coefficients), ``residuals_cancel`` (their mean is nothing beside
    their deviation) and ``gradient_vanishes``: no feature correlates with what is left,
    beyond the part that the small penalty holds back."""
    coefficients = [float(c) for c in model.coefficients]
    guess = F.aggregate(F.zip_with("f", _literal(coefficients), lambda a, b: a * b), F.lit(float(model.intercept)),
                        lambda s, v: s + v)
    rows = model.transform(data).withColumn("f", vector_to_array(features)).withColumn("guess", guess)
    out = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(
        F.abs(F.col("guess") - F.col("prediction")) > TOLERANCE * (1 + F.abs("prediction"))).alias("n_replayed_off"))
    left = train.withColumn("f", vector_to_array(features)).withColumn("e", F.col(label) - guess)
    sums = left.agg(F.avg("e").alias("mean"), F.stddev("e").alias("spread"), F.stddev(label).alias("label_spread"),
                    *[F.covar_pop("e", F.col("f")[j]).alias(f"c{j}") for j in range(len(coefficients))],
                    *[F.stddev_pop(F.col("f")[j]).alias(f"s{j}") for j in range(len(coefficients))])
    slope = F.greatest(*[F.abs(F.col(f"c{j}")) / (F.col(f"s{j}") * F.col("label_spread") + 1e-300)
                         for j in range(len(coefficients))], F.lit(0.0))
    return out.join(sums.select((F.abs("mean") <= FLOAT_TOLERANCE * (F.col("spread") + 1e-9)).alias("residuals_cancel"),
                                (slope <= FLOAT_TOLERANCE).alias("gradient_vanishes")))
