import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from kestrel.functions import dates, scoring, text


def test_range_rules_parse_to_int_pairs(spark):
    bounds = [(7 * k + 3, 7 * k + 9) for k in range(5)]
    df = spark.createDataFrame([(f"{a}-{b}",) for a, b in bounds], "rule string")
    assert rows(df.select(text.parse_range("rule").alias("r")).select("r.start", "r.end")) == bounds


def test_bad_range_gives_null(spark):
    df = spark.createDataFrame([("x-y",), ("5",)], "rule string")
    got = rows(df.select(text.range_start("rule"), text.range_end("rule")))
    assert got == [(None, None), (5, None)]


def test_epoch_to_date_in_session_zone(spark):
    df = spark.createDataFrame([("86400",)], "t string")
    assert df.select(dates.epoch_to_ts_string("t")).first()[0] == "1970-01-02 00:00:00"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert df.select(dates.epoch_to_ts_string("t")).first()[0] == "1970-01-02 05:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_url_to_product_needs_text_after_html(spark):
    df = spark.createDataFrame([("https://shop.test/a/product/42.html?from=list",), ("https://shop.test/product/42.html",),
                                ("https://shop.test/list/1.htm",), (None,)], "u string")
    got = [r[0] for r in df.select(text.url_to_product("u")).collect()]
    assert got == ["42", None, None, None]


def test_date_to_int(spark):
    df = spark.createDataFrame([("2001-02-03",), ("bad",)], "d string")
    assert [r[0] for r in df.select(text.date_to_int("d")).collect()] == [20010203, None]


def _score(spark, values, table, strict):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    return [r[0] for r in df.select(scoring.score(F.col("v"), table, strict)).collect()]


def test_rfm_scores_half_open_by_default(spark):
    vals = [0, 1, 3, 4, 15, 16, 400]
    assert _score(spark, vals, scoring.RFM_RECENCY, False) == [5.0, 5.0, 5.0, 4.0, 2.0, 1.0, 1.0]


def test_strict_scores_keep_the_holes(spark):
    # recency 0 is below the first range; money 49999.5 falls between ranges;
    # engagement 49 is excluded by "< 49" and not in "50-149".
    assert _score(spark, [0, 1], scoring.RFM_RECENCY, True) == [None, 5.0]
    assert _score(spark, [9999.5, 49999.5, 50000], scoring.RFM_MONETARY, True) == [1.0, None, 3.0]
    assert _score(spark, [48, 49, 50], scoring.RFE_ENGAGEMENT, True) == [1.0, None, 2.0]
    assert _score(spark, [49999.5], scoring.RFM_MONETARY, False) == [2.0]
    assert _score(spark, [49], scoring.RFE_ENGAGEMENT, False) == [1.0]


def test_null_measure_scores_null(spark):
    assert _score(spark, [None], scoring.RFM_RECENCY, False) == [None]



def test_relative_window_month_is_30_days(spark):
    df = spark.createDataFrame([(dt.date(2020, 10, 6) - dt.timedelta(days=d),) for d in (0, 1, 30, 31)],
                               "d date")
    got = [r[0] for r in df.where(dates.relative_window("d", "month", 1, "2020-10-06")).collect()]
    assert got == [dt.date(2020, 10, 5), dt.date(2020, 9, 6)]


def test_date_string_shift_and_today(spark):
    df = spark.createDataFrame([("2019-12-31",)], "d string")
    r = df.select(dates.shift_date_string("d", 1), dates.shift_date_string("d", -365),
                  dates.today_string(as_of="2020-07-13")).first()
    assert tuple(r) == ("2020-01-01", "2018-12-31", "2020-07-13")


def test_epoch_helpers_do_not_depend_on_session_zone(spark):
    # 1564441200 = 2019-07-29 23:00 UTC = 16:00 in Los Angeles = 07:00 on the 30th in Shanghai
    df = spark.createDataFrame([(1564441200,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = df.select(dates.epoch_to_date("t", "UTC"), dates.shift_epoch_days_midnight("t", 350, "UTC"),
                      dates.epoch_to_date("t"), dates.epoch_to_date("t", "Asia/Shanghai"),
                      dates.shift_epoch_days_midnight("t", 1, "Asia/Shanghai")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r[0] == dt.date(2019, 7, 29) and r[1] == 1594598400
    assert r[2] == dt.date(2019, 7, 29) and r[3] == dt.date(2019, 7, 30)
    # midnight of 2019-07-31 in Shanghai = 2019-07-30 16:00 UTC
    assert r[4] == 1564502400


def test_ntz_micros(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    assert df.select(dates.ntz_epoch_micros("ts")).first()[0] == 1704067207179575
