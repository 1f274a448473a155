import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import topn
from kestrel.plans import models


def _factors(spark, rows, kind):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"id {kind}, features array<float>")


def _all_pairs(users, items, n):
    out = {}
    for i, v in users:
        scores = {j: float(np.dot(np.float32(v), np.float32(w))) for j, w in items}
        out[i] = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:n]
    return out


@pytest.mark.parametrize("size,n", [(7, 3), (4096, 3), (5, 40)])
def test_blocked_top_n_equals_all_pairs(spark, size, n):
    rng = np.random.default_rng(size)
    # small integers: products are exact, so ties are real ones
    users = [(f"u{k:02d}", rng.integers(-3, 4, 4)) for k in range(30)] + [("zero", np.zeros(4))]
    items = [(int(k), rng.integers(-3, 4, 4) * (1 + k % 3)) for k in range(25)]
    got = {r["id"]: [(x["id"], x["rating"]) for x in r["recommendations"]] for r in
           topn.top_n(_factors(spark, users, "string"), _factors(spark, items, "long"), n, size=size).collect()}
    assert got == _all_pairs(users, items, n)


def test_blocks_are_bounded_and_far_ones_not_met(spark):
    rng = np.random.default_rng(0)
    users = [(k, rng.normal(size=3)) for k in range(40)]
    # long items decide: the many short ones need not be met at all
    items = [(k, rng.normal(size=3) * (1000 if k < 10 else 0.001)) for k in range(200)]
    f = _factors(spark, items, "long")
    packed = topn.blocks(f, 10).collect()
    assert max(len(b["ids"]) for b in packed) <= 10 and sum(len(b["ids"]) for b in packed) == 200
    assert all(len(b["data"]) == 12 * len(b["ids"]) for b in packed)
    got = {r["id"]: [x["id"] for x in r["recommendations"]] for r in
           topn.top_n(_factors(spark, users, "long"), f, 2, size=10).collect()}
    assert got == {i: [j for j, _ in best] for i, best in _all_pairs(users, items, 2).items()}


def test_top_n_of_nothing(spark):
    some, none = _factors(spark, [(1, [1, 2])], "long"), _factors(spark, [], "long")
    assert topn.top_n(some, none, 3).count() == 0 and topn.top_n(none, some, 3).count() == 0


def test_preference_model_measures_itself_and_serves_some_users(spark):
    rng = np.random.default_rng(5)
    logs = spark.createDataFrame([(f"u{u}", f"p{i}") for u in range(12) for i in rng.integers(0, 8, 10).tolist()],
                                 "who string, what string")
    m = models.preference_model(logs, user="who", item=F.col("what"), rank=3, max_iter=4, measure=True)
    pred = m.model.transform(m.ratings).collect()
    assert abs(m.rmse - np.sqrt(np.mean([(r.r - r.prediction) ** 2 for r in pred]))) < 1e-6
    some = spark.createDataFrame([("u3",), ("u3",), ("nobody",)], "x string")
    top = m.top("users", 2, some).collect()
    assert [r["id"] for r in top] == ["u3"] and len(top[0]["recommendations"]) == 2
    uid = m.users.where("__user = 'u3'").first()["uid"]
    own = m.model.recommendForUserSubset(spark.createDataFrame([(uid,)], "uid int"), 2).first()["recommendations"]
    names = {r["iid"]: r["__item"] for r in m.items.collect()}
    assert [names[r["iid"]] for r in own] == [r["id"] for r in top[0]["recommendations"]]


def test_preference_job_saves_a_recommendation_table(spark, tmp_path):
    from kestrel.operators.bucket_store import BucketStore
    from kestrel.plans import jobs
    logs, catalog = str(tmp_path / "logs"), str(tmp_path / "catalog")
    spark.createDataFrame([(u, f"http://shop.test/product/{p}.html?s=1") for u in range(5) for p in (11, 12, 12, 13)],
                          "global_user_id long, loc_url string").write.parquet(logs)
    spark.createDataFrame([(383, "taste", f"inType=parquet\ninPath={logs}\nselectFieldNames=global_user_id,loc_url", 4, 1)],
                          "id long, name string, rule string, level int, pid long").write.parquet(catalog)
    jobs.main(["--catalog", catalog, "--tag", "383", "--model", "preference", "--profile", str(tmp_path / "p"),
               "--recommendations", str(tmp_path / "r"), "--param", "top_n=2"])
    table = BucketStore(spark, str(tmp_path / "r"))
    got = {r.userId: r for r in table.read().collect()}
    assert set(got) == set(range(5)) and not (tmp_path / "p").exists()
    assert all(len(r.productIds.split(",")) == len(r.ratings.split(",")) == 2 for r in got.values())
