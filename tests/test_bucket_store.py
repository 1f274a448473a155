import pytest
from pyspark.sql import functions as F

from conftest import rows
from kestrel.operators.bucket_store import BucketStore
from kestrel.operators.profile import ProfileStore


def _in_buckets(store, spark, buckets, n=400):
    """Ids below ``n`` that fall into some buckets."""
    m = store.manifest()
    return [r.userId for r in spark.range(n).withColumnRenamed("id", "userId")
            .where(store._bucket(m).isin(buckets)).collect()]


def test_a_small_save_rewrites_only_its_buckets(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "p"), buckets=16)
    assert store.read() is None and store.lookup([1]) is None
    assert store.save(spark.createDataFrame([(i, f"g{i % 3}") for i in range(400)], "userId long, gender string")) == 1
    before = store.manifest()
    some = _in_buckets(store, spark, [3, 7])
    assert store.save(spark.createDataFrame([(i, "t") for i in some] + [(None, "x")], "userId long, job string")) == 2
    after = store.manifest()
    changed = {b for b in after.commits if before.commits[b] != after.commits[b]}
    assert changed == {3, 7} and len(after.commits) == 16
    written = {r[0].split("bucket=")[1].split("/")[0] for r in
               store.read().where("job IS NOT NULL").select(F.input_file_name()).distinct().collect()}
    assert written == {"3", "7"}
    got = {r.userId: (r.gender, r.job) for r in store.read().collect()}
    assert len(got) == 400 and all(got[i] == (f"g{i % 3}", "t" if i in some else None) for i in range(400))
    assert rows(store.lookup([some[0], 10**6])) == [(some[0], f"g{some[0] % 3}", "t")]
    assert rows(store.read(1).select("userId").where("userId < 2")) == [(0,), (1,)]


@pytest.mark.parametrize("same", [True, False])
def test_a_slow_save_loses_nothing_and_undoes_nothing(spark, tmp_path, same):
    store = BucketStore(spark, str(tmp_path / "p"), buckets=4)
    store.save(spark.createDataFrame([(i, "m") for i in range(40)], "userId long, gender string"))
    a_ids = _in_buckets(store, spark, [0, 1], 40)
    b_ids = a_ids if same else _in_buckets(store, spark, [2, 3], 40)
    slow = store.prepare(spark.createDataFrame([(i, "a") for i in a_ids], "userId long, job string"))
    assert store.save(spark.createDataFrame([(i, "b") for i in b_ids], "userId long, town string")) == 2
    assert slow.base.version == 1 and slow.commit() == 3
    got = {r.userId: (r.gender, r.job, r.town) for r in store.read().collect()}
    assert got == {i: ("m", "a" if i in a_ids else None, "b" if i in b_ids else None) for i in range(40)}
    # buckets that both wrote were merged again, the others only once
    assert len({c for b, c in store.manifest().commits.items() if b in (0, 1)}) == 1


def test_concurrent_first_saves_meet(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    a, b = (BucketStore(spark, str(tmp_path / "p"), buckets=n) for n in (4, 8))
    late = b.prepare(spark.createDataFrame([(i, "t") for i in range(20)], "userId long, job string"))
    news = [spark.createDataFrame([(i, f"v{k}") for i in range(20)], f"userId long, t{k} string") for k in range(3)]
    with ThreadPoolExecutor(3) as pool:
        assert sorted(pool.map(a.save, news)) == [1, 2, 3]
    assert late.commit() == 4 and b.manifest().buckets == 4
    assert {tuple(sorted(r.asDict().items())) for r in b.read().where("userId = 7").collect()} == {
        (("job", "t"), ("t0", "v0"), ("t1", "v1"), ("t2", "v2"), ("userId", 7))}
    assert b.read().count() == 20


def test_uncommitted_saves_are_not_read_and_vacuum_keeps_what_is_used(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "p"), buckets=2)
    for k in range(4):
        store.save(spark.createDataFrame([(k, "x"), (k, None)], "userId long, tag string"))
    dead = store.prepare(spark.createDataFrame([(9, "dead")], "userId long, tag string"))
    before = rows(store.read())
    assert before == [(k, "x") for k in range(4)]
    assert store.vacuum(keep=1) == []                     # nothing is old enough
    gone = store.vacuum(keep=1, older_than_s=-1)
    assert dead.commit_id in gone and store.versions() == [4] and rows(store.read()) == before


def test_empty_and_replacing_saves(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "r"), buckets=3, replace=True)
    store.save(spark.createDataFrame([], "userId string, productIds string, ratings string"))
    assert store.read().count() == 0
    store.save(spark.createDataFrame([("u1", "1,2", "0.5,0.1"), ("u2", "3", "0.2")],
                                     "userId string, productIds string, ratings string"))
    store.save(spark.createDataFrame([("u1", "9", None)], "userId string, productIds string, ratings string"))
    assert rows(store.read()) == [("u1", "9", None), ("u2", "3", "0.2")]


def test_a_passed_over_profile_save_merges_again(spark, tmp_path):
    """A save that others take for dead still keeps its tag, and theirs."""
    slow, quick = (ProfileStore(spark, str(tmp_path / "p"), stale_s=s) for s in (3600, 0))
    slow.save(spark.createDataFrame([(1, "m")], "userId long, gender string"))
    real = ProfileStore._wait_turn
    turns = []

    def turn(self, files):
        base = real(self, files)
        turns.append(base)
        if len(turns) == 1:       # the slow save has its turn; the quick one passes it over meanwhile
            assert quick.save(spark.createDataFrame([(1, "b")], "userId long, town string")) == 2
        return base

    ProfileStore._wait_turn = turn
    try:
        assert slow.save(spark.createDataFrame([(1, "a")], "userId long, job string")) == 3
    finally:
        ProfileStore._wait_turn = real
    assert slow.read().first().asDict() == {"userId": 1, "gender": "m", "town": "b", "job": "a"}
    assert slow.versions() == [1, 2, 3]
