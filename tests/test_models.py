from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from conftest import SF, rows
from kestrel.operators import ml
from kestrel.operators.profile import ProfileStore
from kestrel.plans import models

CATALOG = "id long, name string, rule string, level int, pid long"
VALUE_TAGS = [(361, "value", "", 4, 1)] + [(362 + i, f"rank{i}", str(i), 5, 361) for i in range(5)]


def _scores(spark):
    # three well separated groups of score vectors
    data = [(i, 5.0, 5.0, 5.0) for i in range(0, 10)] + [(i, 3.0, 3.0, 2.0) for i in range(10, 20)] + \
           [(i, 1.0, 1.0, 1.0) for i in range(20, 30)]
    return spark.createDataFrame(data, "userId long, r_score double, f_score double, m_score double")


def test_kmeans_labels_follow_centre_sum(spark):
    tags = spark.createDataFrame(VALUE_TAGS, CATALOG)
    out = models.kmeans_tag(_scores(spark), ["r_score", "f_score", "m_score"], tags, 3, out="rfm")
    got = dict((r.userId, r.rfm) for r in out.collect())
    assert got[0] == "rank0" and got[15] == "rank1" and got[25] == "rank2"


def test_kmeans_with_fewer_distinct_points_than_k(spark):
    tags = spark.createDataFrame(VALUE_TAGS, CATALOG)
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "userId long, psm double")
    out = models.kmeans_tag(df, ["psm"], tags, 5, out="psm")
    names = dict((r.userId, r.psm) for r in out.collect())
    assert names[3] == "rank0" and names[1] == names[2] and names[1] is not None


def test_kmeans_sweep_keeps_lowest_cost(spark):
    data = ml.assemble(_scores(spark), ["r_score", "f_score", "m_score"])
    best = ml.kmeans_sweep(data, 3)
    costs = [ml.kmeans(data, 3, max_iter=i).summary.trainingCost for i in ml.KMEANS_SWEEP_ITERS]
    assert best.summary.trainingCost == min(costs)


def test_model_store_reuses_saved_model(spark, tmp_path):
    data = ml.assemble(_scores(spark), ["r_score", "f_score", "m_score"])
    store = ml.ModelStore(str(tmp_path / "models"))
    calls = []

    def train():
        calls.append(1)
        return ml.kmeans(data, 3)

    a = store.load_or_train("rfm", KMeansModel, train)
    b = store.load_or_train("rfm", KMeansModel, train)
    assert len(calls) == 1
    assert [list(c) for c in a.clusterCenters()] == [list(c) for c in b.clusterCenters()]
    store.load_or_train("rfm", KMeansModel, train, retrain=True)
    assert len(calls) == 2


def test_rfm_tag_end_to_end(spark):
    tags = spark.createDataFrame(VALUE_TAGS, CATALOG)
    orders = spark.createDataFrame(
        [(u, f"o{u}_{j}", str(100.0 * (u + 1)), str(1577836800 + 86400 * j)) for u in range(12) for j in range(u + 1)],
        "memberid long, ordersn string, orderamount string, finishtime string")
    out = models.rfm_tag(orders, tags, as_of="2020-01-20", k=3, sweep=True)
    assert out.count() == 12 and out.where(F.col("rfm").isNull()).count() == 0


def test_usg_rule_and_learned(spark):
    tags = spark.createDataFrame([(378, "usg", "", 4, 1), (379, "男", "0", 5, 378), (380, "女", "1", 5, 378),
                                  (381, "中性", "-1", 5, 378)], CATALOG)
    lines = spark.createDataFrame(
        [(u, c, p, 1 if c == "pink" else 0) for u in range(6) for c, p in
         [("pink" if u % 2 else "black", "tv"), ("pink" if u % 2 else "black", "fan"), ("black", "fan")]],
        "userId long, colour string, ptype string, label int")
    rule = dict((r.userId, r.usg) for r in models.usg_rule_tag(lines, tags).collect())
    assert rule[0] == "男" and rule[1] == "女"
    learned = dict((r.userId, r.usg) for r in
                   models.usg_learned_tag(lines, tags, categorical=["colour", "ptype"]).collect())
    assert learned == rule


def test_preference_tag_maps_ids_back(spark):
    big = 10**12
    logs = spark.createDataFrame(
        [(big + u, f"https://shop.test/product/{p}.html?x=1") for u in range(4) for p in (901, 22, 22, 7)]
        + [(big, "https://shop.test/product/5.html")], "global_user_id long, loc_url string")
    out = models.preference_tag(logs, top_n=2, rank=2, max_iter=3)
    got = {r.userId: r.productIds.split(",") for r in out.collect()}
    assert set(got) == {big + u for u in range(4)}
    assert all(len(v) == 2 and set(v) <= {"901", "22", "7"} for v in got.values())


def test_int_ids_dense_for_large_keys(spark):
    df = spark.createDataFrame([(10**12 + i * 7,) for i in range(50)], "k long")
    mapped, mapping = ml.int_ids(df, "k", "kid")
    ids = sorted(r.kid for r in mapped.collect())
    assert ids == list(range(50)) and mapping.count() == 50
    text, names = ml.int_ids(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string"), "k", "kid")
    assert sorted(r.kid for r in names.collect()) == [0, 1]
    assert sorted(r.k for r in text.collect()) == ["a", "b", "b"]


def test_template_runs_and_saves(spark, tmp_path):
    rule = "inType=parquet\ntable=customer\nselectFieldNames=c_custkey,c_mktsegment\nfilterConditions=c_nationkey[eq]3"
    catalog = spark.createDataFrame([(400, "segment", rule, 4, 1), (401, "builder", "BUILDING", 5, 400),
                                     (402, "car owner", "AUTOMOBILE", 5, 400)], CATALOG)
    store = ProfileStore(spark, str(tmp_path / "profile"))

    def compute(biz, tags):
        return models.match_tag(biz, tags, "c_mktsegment", key="c_custkey", out="segment")

    out = models.run_tag_model(spark, catalog, 400, compute, store=store, base=SF)
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    want = cust.where((F.col("c_nationkey") == 3) & F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    assert out.count() == want.count() and store.current_version() == 1
    assert rows(store.read(), "userId") == rows(want, "c_custkey")


def test_elbow_reports_each_k(spark):
    data = ml.assemble(_scores(spark), ["r_score", "f_score", "m_score"])
    res = ml.elbow(data, range(2, 4), max_iter=10)
    assert [r["k"] for r in res] == [2, 3] and res[1]["silhouette"] > 0.9
    cos = ml.elbow(data, range(2, 3), max_iter=10, distance="cosine")
    assert cos[0]["k"] == 2


def test_kmeans_tag_with_fewer_distinct_vectors_than_k(spark):
    tags = spark.createDataFrame(VALUE_TAGS, CATALOG)
    for n in (1, 2):
        df = spark.createDataFrame([(i, float(i % n), 1.0) for i in range(12)], "userId long, a double, b double")
        for kw in ({}, {"scale": True}, {"sweep": None}):
            out = models.kmeans_tag(df, ["a", "b"], tags, 5, out="t", **kw).collect()
            assert len(out) == 12 and len({r.t for r in out}) <= max(1, n) and all(r.t for r in out)


def test_null_score_policy_before_clustering(spark):
    # q7: a null score cannot enter the vector; keep leaves the user without a tag, error fails
    import pytest
    tags = spark.createDataFrame(VALUE_TAGS, CATALOG)
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, 5.0)], "userId long, s double")
    out = {r.userId: r.v for r in models.kmeans_tag(df, ["s"], tags, 2, out="v").collect()}
    assert sorted(out) == [1, 2, 3, 4] and out[2] is None and all(out[u] for u in (1, 3, 4))
    with pytest.raises(Exception):
        models.kmeans_tag(df, ["s"], tags, 2, out="v", null_policy="error").collect()
