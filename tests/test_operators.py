import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from kestrel.operators import catalog as cat
from kestrel.operators import cleanup, match, measures, profile

CATALOG = "id long, name string, rule string, level int, pid long"
GENDER = [(318, "性别", "inType=hbase\nhbaseTable=tbl_tag_users", 4, 314),
          (319, "男", "1", 5, 318), (320, "女", "2", 5, 318)]
AGE = [(338, "年龄段", "inType=hbase", 4, 314),
       (339, "50后", "19500101-19591231", 5, 338), (340, "60后", "19600101-19691231", 5, 338),
       (341, "70后", "19700101-19791231", 5, 338), (342, "80后", "19800101-19891231", 5, 338),
       (343, "90后", "19900101-19991231", 5, 338)]


def test_rule_match_modes(spark):
    tags = spark.createDataFrame(GENDER, CATALOG)
    users = spark.createDataFrame([(1, "1"), (2, "2"), (3, "9"), (4, None)], "id long, gender string")
    assert rows(match.rule_match(users, "gender", tags)) == [(1, "男"), (2, "女")]
    assert rows(match.rule_match(users, "gender", tags, on_unmatched="null")) == [
        (1, "男"), (2, "女"), (3, None), (4, None)]
    with pytest.raises(Exception, match="no attribute tag"):
        match.rule_match(users, "gender", tags, on_unmatched="error").collect()


def test_rule_table_dedups_by_smallest_name(spark):
    tags = spark.createDataFrame([(1, "b", "x", 5, 0), (2, "a", "x", 5, 0), (3, "c", "y", 4, 0)], CATALOG)
    assert rows(match.rule_table(tags)) == [("x", "a")]


def test_range_match_age_band(spark):
    tags = spark.createDataFrame(AGE, CATALOG)
    users = spark.createDataFrame([(1, "1992-05-31"), (10, "1980-10-13"), (100, "1993-10-28"),
                                   (101, "1996-08-18"), (7, "2010-01-01")], "id long, birthday string")
    from kestrel.plans.models import age_band_tag
    assert rows(age_band_tag(users, tags)) == [(1, "90后"), (10, "80后"), (100, "90后"), (101, "90后")]


def test_range_match_bucketed_fallback_equals_broadcast(spark):
    ranges = spark.createDataFrame([("a", 0, 7), ("b", 8, 14), ("c", 15, 30), ("d", 31, 1000)],
                                   "name string, start int, end int")
    vals = spark.createDataFrame([(i, i * 7) for i in range(60)], "id long, v int")
    direct = rows(match.range_match(vals, "v", ranges))
    bucketed = rows(match.range_match(vals, "v", ranges, few=2))
    assert direct == bucketed and len(direct) == 60 - sum(1 for i in range(60) if i * 7 > 1000)


def test_most_frequent_ties_to_smallest(spark):
    df = spark.createDataFrame([(1, "wxpay"), (1, "alipay"), (1, "wxpay"), (1, "alipay"), (2, "cod")],
                               "u long, code string")
    assert rows(measures.most_frequent(df, user="u", value="code")) == [(1, "alipay"), (2, "cod")]


def test_rfm_measures(spark):
    df = spark.createDataFrame([(1, "a", "10.10", "2020-01-01"), (1, "b", "0.20", "2020-01-05"),
                                (2, "c", "5", "2019-12-31")], "m long, o string, amt string, ts string")
    got = rows(measures.rfm_measures(df, user="m", order_id="o", amount="amt", ts="ts", as_of="2020-01-10"))
    assert got == [(1, 5, 2, 10.3), (2, 10, 1, 5.0)]


def test_rfe_measures_with_shift(spark):
    df = spark.createDataFrame([(1, "u1", "2020-01-01 10:00:00"), (1, "u1", "2020-01-02 10:00:00"),
                                (1, "u2", "2020-01-03 10:00:00")], "g long, url string, t string")
    got = rows(measures.rfe_measures(df, user="g", ts="t", page="url", as_of="2020-07-20", shift_days=200))
    assert got == [(1, -1, 3, 2)]


def test_psm_no_coupon_gets_default(spark):
    df = spark.createDataFrame([(1, "a", 100.0, 0.0), (1, "b", 50.0, 10.0), (2, "c", 80.0, 0.0)],
                               "m long, o string, amt double, cp double")
    got = {r.userId: r for r in measures.psm_measures(
        df, user="m", order_id="o", amount=F.col("amt"), coupon=F.col("cp")).collect()}
    # user 1: tdonr 1/2, tdar 10/160, adar (10/1)/(160/2)
    assert abs(got[1].psm - (0.5 + 10 / 160 + 10 / 80)) < 1e-12
    assert got[2].adar is None and got[2].psm == 1e-8


def test_share_rule(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (2, 1), (2, 1), (2, 0), (3, 0), (3, 1)],
                               "userId long, label int")
    c = measures.share_counts(df)
    got = rows(c.select("userId", measures.share_rule(F.col("total"), F.col("male_total"),
                                                      F.col("female_total"))))
    assert got == [(1, "0"), (2, "1"), (3, "-1")]


def test_upsert_is_cell_level_and_idempotent(spark):
    old = spark.createDataFrame([(1, "m", "x"), (2, "f", None)], "userId long, gender string, job string")
    new = spark.createDataFrame([(2, "teacher"), (3, "student"), (1, None)], "userId long, job string")
    once = profile.upsert(old, new)
    assert rows(once) == [(1, "m", "x"), (2, "f", "teacher"), (3, None, "student")]
    assert rows(profile.upsert(once, new)) == rows(once)


def test_profile_store_versions(spark, tmp_path):
    store = profile.ProfileStore(spark, str(tmp_path / "profile"))
    assert store.read() is None
    store.save(spark.createDataFrame([(1, "m")], "userId long, gender string"))
    store.save(spark.createDataFrame([(2, "1")], "userId long, usg string"))
    assert store.current_version() == 2
    assert rows(store.read(), "userId", "gender", "usg") == [(1, "m", None), (2, None, "1")]


def test_to_cells_sorted_and_without_blanks(spark):
    df = spark.createDataFrame([(2, "b", " "), (1, "a", "x")], "id long, Name string, job string")
    cells = profile.to_cells(df, "id", "detail")
    got = [tuple(r) for r in cells.collect()]
    assert got == [("1", "detail", "id", "1"), ("1", "detail", "job", "x"), ("1", "detail", "name", "a"),
                   ("2", "detail", "id", "2"), ("2", "detail", "name", "b")]
    assert [r.qualifier for r in profile.to_cells(df, "id", "d", include_key=False).collect()] == [
        "job", "name", "name"]


def test_tags_string_to_cells_and_pivot(spark):
    df = spark.createDataFrame([(1001, "gender:男,job:教师"), (1002, "gender:女")], "id long, tags string")
    cells = profile.tags_string_to_cells(df, "id", "tags")
    assert rows(cells) == [(1001, "gender", "男"), (1001, "job", "教师"), (1002, "gender", "女")]
    wide = profile.cells_to_wide(cells, ["gender", "job"])
    assert rows(wide) == [(1001, "男", "教师"), (1002, "女", None)]


def test_recommendations_to_strings(spark):
    df = spark.createDataFrame([(1, [(10, 0.5), (11, 0.25)])],
                               "userId long, recommendations array<struct<productId:long,rating:double>>")
    assert rows(profile.recommendations_to_strings(df)) == [(1, "10,11", "0.5,0.25")]


def test_sync_strings_lowercases_and_nulls_blanks(spark):
    df = spark.createDataFrame([(1, "  ", 2.5)], "ID long, Name string, Score double")
    out = profile.sync_strings(df)
    assert out.columns == ["id", "name", "score"] and rows(out) == [("1", None, "2.5")]


def test_fetch_children_paths(spark):
    tree = [(307, "电商", "", 1, -1), (308, "某商城", "", 2, 307), (309, "人口属性", "", 3, 308),
            (318, "性别", "r", 4, 309), (319, "男", "1", 5, 318), (320, "女", "2", 5, 318)]
    tags = spark.createDataFrame(tree, CATALOG)
    assert [r.id for r in cat.fetch_tag(tags, 318).collect()] == [318, 319, 320]
    assert rows(cat.children(tags, 318), "id") == [(319,), (320,)]
    assert rows(cat.paths(tags)) == [(319, "电商/某商城/人口属性/性别/男"), (320, "电商/某商城/人口属性/性别/女")]


def test_merge_chains_get_or_create(spark):
    existing = spark.createDataFrame([(1, "shop", 1, -1), (2, "people", 2, 1)],
                                     "id long, name string, level int, pid long")
    chains = spark.createDataFrame([("shop", "people", "gender"), ("shop", "goods", "colour"),
                                    ("shop", "people", "gender")], "l1 string, l2 string, l3 string")
    out = cat.merge_chains(existing, chains, ["l1", "l2", "l3"])
    assert rows(out) == [(1, "shop", 1, -1), (2, "people", 2, 1), (3, "goods", 2, 1),
                         (4, "gender", 3, 2), (5, "colour", 3, 3)]
    again = cat.merge_chains(out, chains, ["l1", "l2", "l3"])
    assert rows(again) == rows(out)


def test_with_models_left_join(spark):
    tags = spark.createDataFrame([(1, "a", "", 4, 9), (2, "b", "", 4, 9), (3, "c", "", 4, 8)], CATALOG)
    models = spark.createDataFrame([(50, 1, "GenderModel")], "id long, tag_id long, model_name string")
    got = rows(cat.with_models(tags, models, parent_id=9), "id", "model_id", "model_name")
    assert got == [(1, 50, "GenderModel"), (2, None, None)]


def test_dict_encode_unknown_is_zero(spark):
    dim = spark.createDataFrame([(1, "电视"), (2, "冰箱")], "id int, name string")
    df = spark.createDataFrame([("电视",), ("料理机",)], "producttype string")
    assert rows(cleanup.dict_encode(df, "producttype", dim, out="product")) == [("料理机", 0), ("电视", 1)]


def test_mean_impute(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.333)], "id long, age double")
    assert rows(cleanup.mean_impute(df, ["age"])) == [(1, 1.0), (2, 1.67), (3, 2.333)]


def test_clean_orders_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "alipay", 1564415022), (2, 960, "paypal", 1565687310)],
                               "k long, memberid long, paymentcode string, finishtime long")
    out = cleanup.clean_orders(df, key="k", member="memberid", pay_code="paymentcode",
                               finish="finishtime", member_limit=950)
    a, b = sorted(out.collect(), key=lambda r: r.k)
    assert a.memberid == 5 and a.paymentcode == "alipay" and a.paymentname == "支付宝"
    assert 1 <= b.memberid <= 950 and b.paymentcode in cleanup.PAY_CODES
    # 2019-07-29 + 350 days = 2020-07-13, midnight UTC
    assert a.finishtime == 1594598400
    assert rows(out) == rows(cleanup.clean_orders(df, key="k", member="memberid", pay_code="paymentcode",
                                                  finish="finishtime", member_limit=950))


def test_hot_row_key_spreads_and_stays_ordered(spark):
    # one row key owns most cells (a skewed log export)
    data = [(0, f"v{i:05d}") for i in range(3000)] + [(k, "x") for k in range(1, 200)]
    df = spark.createDataFrame(data, "k long, url string")
    cells = profile.to_cells(df, "k", "d", include_key=False, partitions=8)
    per_part = cells.rdd.glom().map(len).collect()
    assert max(per_part) < 3000          # the hot key is split
    got = [(r.row_key, r.qualifier, r.value) for r in cells.collect()]
    assert got == sorted(got) and len(got) == 3199


def test_hot_user_aggregates(spark):
    # a third of the rows belong to one user
    rows_ = [(1, "alipay" if i % 3 else "cod", f"p{i % 7}") for i in range(3000)] + \
            [(u, "wxpay", "p1") for u in range(2, 6002)]
    df = spark.createDataFrame(rows_, "u long, code string, page string")
    top = dict((r.userId, r.code) for r in measures.most_frequent(df, user="u", value="code").collect())
    assert top[1] == "alipay" and top[2] == "wxpay" and len(top) == 6001
    e = measures.rfe_measures(df.withColumn("ts", F.lit("2020-01-01")), user="u", ts="ts", page="page",
                              as_of="2020-01-02")
    hot = e.where("userId = 1").first()
    assert (hot.frequency, hot.engagements, hot.recency) == (3000, 7, 1)


def test_range_gap_drops_or_keeps(spark):
    # q20: a value outside every range gives no row, unless kept with a null tag
    cycles = spark.createDataFrame([(348, "0-7", "0-7", 5, 347), (349, "8-14", "8-14", 5, 347)], CATALOG)
    users = spark.createDataFrame([(1, 3), (2, 10), (3, 200)], "id long, days int")
    assert rows(match.range_match(users, "days", cycles)) == [(1, "0-7"), (2, "8-14")]
    assert rows(match.range_match(users, "days", cycles, on_unmatched="null")) == [
        (1, "0-7"), (2, "8-14"), (3, None)]


def test_literal_tables_are_bounded_without_a_job(spark):
    import pandas as pd
    from kestrel.operators import broadcast
    lit = spark.createDataFrame(pd.DataFrame({"rule": ["1", "2"], "name": ["a", "b"]}))
    assert broadcast._literal_bound(lit.groupBy("rule").count()) == 2
    assert broadcast._literal_bound(spark.read.parquet(f"{SF}/nation.parquet")) is None
    assert broadcast.within(lit, 1) is False and broadcast.within(lit, 2) is True


def test_range_match_bucketed_default_width(spark):
    ranges = spark.createDataFrame([(f"r{i}", i * 10, i * 10 + 9) for i in range(50)],
                                   "name string, start int, end int")
    vals = spark.createDataFrame([(i, i * 3) for i in range(200)], "id long, v int")
    assert rows(match.range_match(vals, "v", ranges, few=10)) == rows(match.range_match(vals, "v", ranges))


def test_rfe_approx_distinct_close_to_exact(spark):
    df = spark.createDataFrame([(u, f"p{i % (50 + u)}", "2020-01-01") for u in range(3) for i in range(400)],
                               "u long, page string, ts string")
    exact = dict((r.userId, r.engagements) for r in
                 measures.rfe_measures(df, user="u", ts="ts", page="page", as_of="2020-01-02").collect())
    approx = dict((r.userId, r.engagements) for r in
                  measures.rfe_measures(df, user="u", ts="ts", page="page", as_of="2020-01-02",
                                        approx_rsd=0.01).collect())
    assert exact == {0: 50, 1: 51, 2: 52}
    assert all(abs(approx[u] - exact[u]) <= 2 for u in exact)


def test_per_order_partials_equal_line_aggregation(spark):
    # a hot user owns a third of the lines; sums are exact, so pre-aggregating
    # per order and then per user gives the line-level result exactly
    import random
    rnd = random.Random(9)
    lines = []
    for o in range(900):
        user = 1 if o % 3 == 0 else 2 + o % 50
        for _ in range(rnd.randint(1, 6)):
            price = rnd.randint(100, 500000)          # cents
            disc = rnd.choice([0, 0, 5, 10, 20])      # percent
            coupon = price * disc // 100 if disc >= 10 else 0
            lines.append((o, user, price - coupon, coupon, rnd.randint(0, 1)))
    df = spark.createDataFrame(lines, "o long, u long, amt long, cp long, label int")
    direct = rows(measures.psm_measures(df, user="u", order_id="o", amount=F.col("amt"),
                                        coupon=F.col("cp"), cents=True))
    per_order = measures.psm_partial_sums(df, ["o", "u"], amount=F.col("amt"), coupon=F.col("cp"), cents=True)
    staged = rows(measures.psm_from_sums(per_order, user="u", cents=True))
    assert direct == staged
    shares = rows(measures.share_counts(df, user="u"))
    staged_shares = rows(measures.share_from_partials(measures.share_partials(df, ["o", "u"]), user="u"))
    assert shares == staged_shares


def test_tags_string_with_repeated_field_and_colon_value(spark):
    df = spark.createDataFrame([(1, "gender:m,gender:f,url:http://x,flag")], "id long, tags string")
    got = rows(profile.tags_string_to_cells(df, "id", "tags"))
    assert got == [(1, "flag", None), (1, "gender", "f"), (1, "gender", "m"), (1, "url", "http://x")]


def test_range_match_overlaps_wide_and_malformed_ranges(spark):
    ranges = spark.createDataFrame([(f"r{i}", i * 10, i * 10) for i in range(9)] + [("open", 5, 2**40), ("z", 10, 10)],
                                   "name string, start long, end long")
    vals = spark.createDataFrame([(i, i * 5) for i in range(100)] + [(200, None)], "id long, v long")
    a = rows(match.range_match(vals, "v", ranges, on_unmatched="null"))
    assert a == rows(match.range_match(vals, "v", ranges, on_unmatched="null", few=2))
    got = dict(a)
    assert got[0] == "r0" and got[2] == "open" and got[99] == "open" and got[200] is None and len(a) == 101
    tags = spark.createDataFrame([(1, "ok", "0-5", 5, 0), (2, "bad", "0~10", 5, 0)],
                                 "id long, name string, rule string, level int, pid long")
    with pytest.raises(ValueError, match="bad"):
        match.range_match(vals, "v", tags)
