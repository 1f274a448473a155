"""Catalog trees of any depth, merged chains, range search, typed conditions, split export."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from kestrel.operators import catalog as cat
from kestrel.operators import match
from kestrel.sources import conditions, meta, sinks

TREE = "id long, name string, rule string, level int, pid long"


@pytest.mark.parametrize("depth", [1, 2, 5, 9, 16, 17])
def test_paths_of_any_depth(spark, depth):
    tree = [(i, f"n{i}", "", i, i - 1 if i > 1 else -1) for i in range(1, depth + 1)]
    tree += [(100 + i, f"leaf{i}", "", depth + 1, depth) for i in range(3)] + [(500, "lost", "", 4, 499)]
    tags = spark.createDataFrame(tree, TREE)
    stem = "/".join(f"n{i}" for i in range(1, depth + 1))
    got = dict(rows(cat.paths(tags, level=None)))
    assert got == ({i: "/".join(f"n{k}" for k in range(1, i + 1)) for i in range(1, depth + 1)}
                   | {100 + i: f"{stem}/leaf{i}" for i in range(3)} | {500: "lost"})
    assert cat.paths(tags, level=99).count() == 0


def test_a_cycle_fails_with_its_tag(spark):
    tags = spark.createDataFrame([(1, "a", "", 1, -1), (7, "x", "", 2, 9), (8, "y", "", 2, 7), (9, "z", "", 2, 8)], TREE)
    with pytest.raises(ValueError, match="tag 7"):
        cat.paths(tags, level=None)
    assert cat.paths(spark.createDataFrame([], TREE)).count() == 0


def test_concurrent_merges_make_each_tag_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    store = cat.CatalogStore(spark, str(tmp_path / "cat"))
    names = ["l1", "l2", "l3"]

    def chains(*rows_):
        return spark.createDataFrame(rows_, "l1 string, l2 string, l3 string")

    assert store.read() is None and store.merge(chains(("shop", "people", "gender")), names) == 1
    jobs = [chains(("shop", "people", "job"), ("shop", "goods", f"g{k}")) for k in range(3)]
    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(lambda c: store.merge(c, names), jobs))
    assert store.version() == max(versions) == 4
    tags = store.read().collect()
    assert len({t.id for t in tags}) == len({(t.name, t.pid) for t in tags}) == len(tags) == 8
    assert store.merge(jobs[0], names) == 4            # nothing missing: no new version


def _plain(value, ranges):
    hits = [(a if a is not None else -(1 << 63), n) for a, b, n in ranges
            if (a is None or a <= value) and (b is None or value <= b)]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("n", [3, 300])
def test_ranges_by_case_search_and_join_agree_with_a_plain_scan(spark, n):
    rnd = random.Random(n)
    big = (1 << 63) - 1
    ranges = [(a, a + rnd.choice([0, 3, 40, 10**6]), f"r{k:03d}") for k, a in
              enumerate(rnd.randint(-3000, 3000) for _ in range(n))]
    ranges += [(None, -2900, "low"), (2950, None, "high"), (big - 5, big, "top"), (-big - 1, -big, "bottom")]
    values = [rnd.randint(-3200, 3200) for _ in range(400)] + [big, -big - 1, big - 6, 0, 10**17 + 1]
    table = spark.createDataFrame([(name, a, b) for a, b, name in ranges], "name string, start long, end long")
    users = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(9999, None)], "id long, v long")
    want = [(i, _plain(v, ranges)) for i, v in enumerate(values)] + [(9999, None)]
    for limits in ({"few": 10**4}, {"few": 2}, {"few": 2, "many": 3}):
        got = rows(match.range_match(users, "v", table, on_unmatched="null", **limits))
        assert got == want, limits
        some = rows(match.range_match(users, "v", table, **limits))
        assert some == [w for w in want if w[1] is not None]


def test_disjoint_ranges_cover_the_same_values():
    assert match.disjoint([(0, 10, "a"), (5, 20, "b"), (5, 7, "c"), (30, 40, "d"), (30, 35, "c")]) == [
        (0, 10, "a"), (11, 20, "b"), (30, 35, "c"), (36, 40, "d")]
    assert match.disjoint([(None, None, "all")]) == [(-(1 << 63), (1 << 63) - 1, "all")]
    assert match.disjoint([]) == []


def test_range_search_has_no_join_and_one_job(spark):
    from kestrel.plans import shop
    plan = shop.price_band(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_typed_conditions_equal_text_conditions(spark):
    days = [dt.date(1999, 12, 31), dt.date(2000, 1, 1), dt.date(2000, 1, 2), None]
    times = [dt.datetime(1999, 12, 31, 23, 59, 59, 999999), dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1, 0, 0, 0, 5),
             dt.datetime(2000, 1, 1, 12), None]
    df = spark.createDataFrame([(k, d, t) for k, (d, t) in enumerate((d, t) for d in days for t in times)],
                               "n int, d date, t timestamp_ntz")
    literals = {"d": ["2000-01-01", "2000-1-1", "2000-02-30", "x"],
                "t": ["2000-01-01", "2000-01-01 00:00:00", "2000-01-01 12:00:00", "2000-01-01 24:00:00", "2000"],
                "n": ["3", "03", "-1", "", "10"]}
    typed = 0
    for field, values in literals.items():
        kind = dict(df.dtypes)[field]
        for value in values:
            for op in conditions.OPERATORS:
                c = conditions.Condition(field, op, value)
                typed += c.typed(kind) is not None
                for passes in (True, False):
                    assert rows(df.where(c.column(passes, kind)), "n") == rows(df.where(c.column(passes)), "n"), (c, passes)
    assert typed == 6 + 18 + 6     # a date; a day and two times; equality with 3, -1 and 10


def test_dates_and_numbers_reach_the_scan(spark):
    df = meta.wide_scan(spark, f"{SF}/orders.parquet", ["o_orderkey"], "o_orderdate[GE]1997-01-01,o_custkey[eq]7")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan and "EqualTo(o_custkey,7)" in plan


def test_split_export_never_crosses_a_split(spark, tmp_path):
    users = spark.createDataFrame([(f"k{i:03d}", f"v{i}") for i in range(200)] + [("k050", f"w{i}") for i in range(300)],
                                  "id string, tag string")
    path, splits = str(tmp_path / "x"), ["k050", "k051", "k150"]
    files = sinks.export_split_cells(users, "id", "f", path, splits, include_key=False).collect()
    edges = ["", *splits, "~"]
    assert sum(f.n_cells for f in files) == 500 and {f.region for f in files} == {0, 1, 2, 3}
    for f in files:
        assert edges[f.region] <= f.first_key <= f.last_key < edges[f.region + 1]
        keys = [r[0] for r in spark.read.parquet(f.file).select("row_key").collect()]
        assert keys == sorted(keys) and (keys[0], keys[-1], len(keys)) == (f.first_key, f.last_key, f.n_cells)
    ordered = sorted(files, key=lambda f: (f.region, f.first_key, f.last_key))
    assert all(a.last_key <= b.first_key for a, b in zip(ordered, ordered[1:]))
    back = meta.cells_scan(spark, path, "f", ["tag"])
    assert back.count() == 200
