import re
from pyspark.sql import functions as F

import pytest
from conftest import rows
from kestrel.operators import ml, profile
from kestrel.operators.profile import ProfileStore
from kestrel.plans import models
from kestrel.streaming.profile_sink import start_tag_stream

CATALOG = "id long, name string, rule string, level int, pid long"
DAY = 86400


def test_sync_table_upserts_without_blanks(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"))
    store.save(spark.createDataFrame([("1", "x")], "userId string, job string"))
    src = spark.createDataFrame([(1, " ", "m"), (2, "y", "")], "ID long, JOB string, Gender string")
    assert profile.sync_table(src, "ID", store) == 2
    assert rows(store.read(), "userId", "job", "gender") == [("1", "x", "m"), ("2", "y", None)]


def test_log_lines_to_cells_drops_wrong_width_and_key(spark):
    lines = spark.createDataFrame([("7\tu\t",), ("8\tv",), ("9\tw\tz",)], "value string")
    cells = profile.log_lines_to_cells(lines, ["id", "url", "t"], "id", "detail")
    assert [tuple(r) for r in cells.collect()] == [("7", "detail", "url", "u"), ("9", "detail", "t", "z"),
                                                   ("9", "detail", "url", "w")]


def test_rating_model_rmse_and_both_directions(spark):
    data = [(u, i, float((u * i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    ratings = spark.createDataFrame(data, "user long, item long, score double")
    m = models.rating_model(ratings, user="user", item="item", rating="score", rank=4, max_iter=5)
    assert m.rmse == m.rmse and m.rmse < 5
    per_item = models.top_users_per_item(m, 3)
    assert per_item.count() == 15
    assert all(len(r.userIds.split(",")) == 3 for r in per_item.collect())
    assert models.top_items_per_user(m, 2).count() == 20
    some = spark.createDataFrame([(3,), (99,)], "userId long")
    assert [r.userId for r in models.top_items_per_user(m, 2, some).collect()] == [3]
    assert m.factors("users").count() == 20 and m.factors("items").count() == 15


def test_rating_model_with_string_and_null_ids_saves_and_loads(spark, tmp_path):
    data = [(f"u{u}", f"p{i}", float((u * i) % 5 + 1)) for u in range(8) for i in range(6)]
    ratings = spark.createDataFrame(data + [(None, "p1", 2.0), ("u1", None, 1.0), ("u1", "p1", None)],
                                    "user string, item string, score double")
    m = models.rating_model(ratings, user="user", item="item", rating="score", rank=3, max_iter=3)
    before = rows(models.top_users_per_item(m, 2))
    m.save(str(tmp_path / "als"))
    again = models.RatingModel.load(spark, str(tmp_path / "als"))
    assert rows(models.top_users_per_item(again, 2)) == before and len(before) == 6
    logs = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "a"), (None, "a")], "who string, what string")
    pref = models.preference_tag(logs, user="who", item=F.col("what"), top_n=1, rank=2, max_iter=2)
    assert {r.userId for r in pref.collect()} == {"u1", "u2"}


def test_train_validation_split_tree(spark):
    df = spark.createDataFrame([(float(i % 4), float(i % 3), float(i % 4 > 1)) for i in range(120)],
                               "a double, b double, label double")
    tvs = ml.train_validation_split(ml.tree_pipeline(["a", "b"]), df, depths=(2, 3))
    acc = ml.accuracy(tvs.bestModel.transform(df))
    assert acc == 1.0


def test_streaming_upsert_sink(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "1"), (2, "2")], "id long, gender string").write.parquet(str(src / "b1"))
    tags = spark.createDataFrame([(318, "gender", "", 4, 1), (319, "m", "1", 5, 318), (320, "f", "2", 5, 318)],
                                 CATALOG)
    store = profile.TagColumnStore(spark, str(tmp_path / "profile"))
    stream = spark.readStream.schema("id long, gender string").parquet(str(src / "*"))
    q = start_tag_stream(stream, store, str(tmp_path / "ckpt"),
                         compute=lambda b: models.match_tag(b, tags, "gender"))
    q.processAllAvailable()
    spark.createDataFrame([(2, "1"), (3, "2")], "id long, gender string").write.parquet(str(src / "b2"))
    q.processAllAvailable()
    q.stop()
    assert rows(store.read(), "userId", "gender") == [(1, "m"), (2, "m"), (3, "f")]


def test_bucketed_profile_join_shuffles_only_new_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = profile.BucketedProfileTable(spark, "kestrel_profile_t", buckets=4)
        for t in store.versions():
            spark.sql(f"DROP TABLE IF EXISTS kestrel_profile_t_v{t}")
        store.save(spark.createDataFrame([(i, f"g{i % 2}") for i in range(100)], "userId long, gender string"))
        new = spark.createDataFrame([(i, "x") for i in range(50, 150)], "userId long, job string")
        merged = profile.upsert(store.read(), new)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        # one exchange (new side), none for the bucketed profile scan
        # the new side only: once to one row a key, once into the stored buckets
        assert plan.count("Exchange hashpartitioning") == 2 and not re.search(
            r"Exchange hashpartitioning[^\n]*\n\s*\+- (Sort[^\n]*\n\s*\+- )?(Filter[^\n]*\n\s*\+- )?FileScan", plan)
        v = store.save(new)
        assert v == 2 and store.read().count() == 150
        assert rows(store.read().where("userId = 60"), "userId", "gender", "job") == [(60, "g0", "x")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_job_runner_rule_and_cycle_models(spark, tmp_path):
    from kestrel.plans import jobs
    users = str(tmp_path / "users")
    spark.createDataFrame([(1, "1"), (2, "2"), (3, "1")], "id long, gender string").write.parquet(users)
    orders = str(tmp_path / "orders")
    spark.createDataFrame([(1, DAY * 95), (1, DAY * 80), (2, DAY * 10)],
                          "memberid long, finishtime long").write.parquet(orders)
    catalog = spark.createDataFrame(
        [(318, "gender", f"inType=parquet\ninPath={users}\nselectFieldNames=id,gender", 4, 1),
         (319, "m", "1", 5, 318), (320, "f", "2", 5, 318),
         (347, "cycle", f"inType=parquet\ninPath={orders}\nselectFieldNames=memberid,finishtime", 4, 1),
         (348, "0-7", "0-7", 5, 347), (349, "8-14", "8-14", 5, 347)], CATALOG)
    store = ProfileStore(spark, str(tmp_path / "profile"))
    jobs.run(spark, catalog, 318, "gender", store=store)
    jobs.run(spark, catalog, 347, "consume_cycle", store=store, as_of="1970-04-16")
    assert rows(store.read(), "userId", "gender", "consumecycle") == [
        (1, "m", "8-14"), (2, "f", None), (3, "m", None)]


def test_tag_column_store_matches_wide_upsert(spark, tmp_path):
    store = profile.TagColumnStore(spark, str(tmp_path / "cols"))
    a = spark.createDataFrame([(1, "m", "x"), (2, "f", None)], "userId long, gender string, job string")
    b = spark.createDataFrame([(2, "teacher"), (3, "student"), (1, None)], "userId long, job string")
    assert store.save(a) == {"gender": 1, "job": 1}
    assert store.save(b) == {"job": 2}          # gender is not rewritten
    assert store.tags() == ["gender", "job"]
    wide = profile.upsert(a.selectExpr("userId", "gender", "job"), b)
    assert rows(store.read(), "userId", "gender", "job") == rows(wide)


def test_job_cli_columns_layout(spark, tmp_path, capsys):
    from kestrel.plans import jobs
    users = str(tmp_path / "users")
    spark.createDataFrame([(1, "3"), (2, "5")], "id long, job string").write.parquet(users)
    cat_path = str(tmp_path / "catalog")
    spark.createDataFrame([(321, "job", f"inType=parquet\ninPath={users}\nselectFieldNames=id,job", 4, 1),
                           (324, "soldier", "3", 5, 321), (326, "teacher", "5", 5, 321)],
                          CATALOG).write.parquet(cat_path)
    jobs.main(["--catalog", cat_path, "--tag", "321", "--model", "job",
               "--profile", str(tmp_path / "p"), "--layout", "columns"])
    assert "saved" in capsys.readouterr().out
    got = profile.TagColumnStore(spark, str(tmp_path / "p")).read()
    assert rows(got, "userId", "job") == [(1, "soldier"), (2, "teacher")]


def test_streaming_sink_replay_is_idempotent(spark, tmp_path):
    # a micro-batch replayed after a failure leaves the same profile
    from kestrel.streaming.profile_sink import upsert_batches
    with pytest.raises(TypeError):
        upsert_batches(ProfileStore(spark, str(tmp_path / "w")))
    store = profile.TagColumnStore(spark, str(tmp_path / "p"))
    run = upsert_batches(store)
    b1 = spark.createDataFrame([(1, "m"), (2, "f")], "userId long, gender string")
    b2 = spark.createDataFrame([(2, "m"), (3, None)], "userId long, gender string")
    run(b1, 0)
    run(b2, 1)
    once = rows(store.read())
    run(b2, 1)                       # replay of batch 1
    assert rows(store.read()) == once == [(1, "m"), (2, "m")]


def test_uncommitted_profile_version_is_ignored(spark, tmp_path):
    # a job that died mid-write leaves a folder without _SUCCESS: not current
    root = tmp_path / "p"
    store = ProfileStore(spark, str(root))
    store.save(spark.createDataFrame([(1, "m")], "userId long, gender string"))
    (root / "v=2").mkdir()
    (root / "v=2" / "part-00000.parquet").write_bytes(b"partial")
    assert store.current_version() == 1 and rows(store.read()) == [(1, "m")]
    assert store.save(spark.createDataFrame([(2, "f")], "userId long, gender string")) == 2
    assert rows(store.read()) == [(1, "m"), (2, "f")] and store.prune(1) == [1] and store.versions() == [2]


def test_upsert_takes_duplicate_and_null_keys_once(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"))
    new = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (2, None)], "userId long, tag string")
    for _ in range(3):
        store.save(new)
        assert rows(store.read()) == [(1, "b"), (2, None)]


def test_concurrent_saves_lose_no_tag(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    store = ProfileStore(spark, str(tmp_path / "p"))
    store.save(spark.createDataFrame([(1, "m")], "userId long, gender string"))
    news = [spark.createDataFrame([(1, f"v{i}")], f"userId long, t{i} string") for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(store.save, news))
    r = store.read().first().asDict()
    assert r == {"userId": 1, "gender": "m", "t0": "v0", "t1": "v1", "t2": "v2"}


def test_checkpoint_folder_is_registered_once(spark):
    from kestrel.session import ensure_checkpoint_dir
    assert len({ensure_checkpoint_dir(spark) for _ in range(200)}) == 1


def test_model_store_fails_on_another_type(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.clustering import KMeansModel
    from kestrel.operators import ml
    data = ml.assemble(spark.createDataFrame([(0.0,), (1.0,), (9.0,)], "x double"), ["x"])
    store = ml.ModelStore(str(tmp_path))
    saved = store.load_or_train("m", KMeansModel, lambda: ml.kmeans(data, 2))
    with pytest.raises(Exception):
        store.load_or_train("m", LogisticRegressionModel, lambda: ml.kmeans(data, 3))
    assert len(KMeansModel.load(store.path("m")).clusterCenters()) == len(saved.clusterCenters()) == 2


def test_job_parameters_and_purchase_gender(spark, tmp_path):
    from kestrel.plans import jobs
    assert [jobs._typed(x) for x in ("3", "0.5", "true", "abc")] == [3, 0.5, True, "abc"]
    lines = spark.createDataFrame([(1, "c1", "k1"), (1, "c1", "k9"), (2, "c2", "k2"), (3, "c1", "k2"), (3, "c2", "k2")],
                                  "memberid long, ogcolor string, producttype string")
    spark.createDataFrame([("c1", "rose")], "id string, name string").write.parquet(str(tmp_path / "colours"))
    tags = spark.createDataFrame([(1, "usg", "", 4, 0), (2, "male", "0", 5, 1), (3, "female", "1", 5, 1),
                                  (4, "neutral", "-1", 5, 1)], CATALOG)
    for name in ("usg", "usg_learned"):
        out = jobs.MODELS[name](lines, tags, colour_table=str(tmp_path / "colours"), female_colours="rose")
        assert rows(out) == [(1, "female"), (2, "male"), (3, "neutral")]
