import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from kestrel.sources import conditions, meta
from kestrel.sources.tables import Tables

CATALOG = "id long, name string, rule string, level int, pid long"


def test_parse_rule_first_equals_and_trim(spark):
    rule = ("inType=mysql\n  driver=com.mysql.jdbc.Driver \n"
            "url=jdbc:mysql://h:3306/?useUnicode=true&characterEncoding=UTF-8\n"
            "sql=SELECT id, gender FROM users WHERE a=1\nsperator=\\t")
    tags = spark.createDataFrame([(318, "gender", rule, 4, 1), (319, "m", "1", 5, 318)], CATALOG)
    r = meta.parse_rule(tags)
    assert r["inType"] == "mysql" and r["driver"] == "com.mysql.jdbc.Driver"
    assert r["url"].endswith("useUnicode=true&characterEncoding=UTF-8")
    assert r["sql"] == "SELECT id, gender FROM users WHERE a=1"
    assert r["sperator"] == "\t"


def test_parse_rule_needs_one_business_tag(spark):
    tags = spark.createDataFrame([(319, "m", "1", 5, 318)], CATALOG)
    with pytest.raises(ValueError):
        meta.parse_rule(tags)


def test_unknown_in_type_raises(spark):
    with pytest.raises(ValueError, match="unknown inType"):
        meta.read_source(spark, {"inType": "kafka"})


def test_condition_parse_and_ops():
    cs = conditions.parse_conditions("seen[lt]2011-04-05, kind[EQ]b7")
    assert [(c.field, c.op, c.value) for c in cs] == [("seen", "lt", "2011-04-05"), ("kind", "eq", "b7")]
    with pytest.raises(ValueError):
        conditions.Condition.parse("seen<2011")


def test_wide_scan_strings_and_conditions(spark, tmp_path):
    p = str(tmp_path / "users")
    spark.createDataFrame([(1, "2011-03-01", 1), (2, "2011-06-01", 2), (3, None, 1)],
                          "id long, seen string, kind int").write.parquet(p)
    got = meta.wide_scan(spark, p, "id,seen", "seen[lt]2011-04-05")
    assert dict(got.dtypes) == {"id": "string", "seen": "string"}
    assert rows(got) == [("1", "2011-03-01"), ("3", None)]
    strict = meta.wide_scan(spark, p, ["id"], "seen[lt]2011-04-05", missing_passes=False)
    assert rows(strict) == [("1",)]
    assert rows(meta.wide_scan(spark, p, ["id"], "kind[eq]1,seen[ge]2011-01-01")) == [("1",), ("3",)]


def test_wide_scan_pushes_filters_to_parquet(spark):
    df = meta.wide_scan(spark, f"{SF}/orders.parquet", ["o_orderkey"], "o_orderstatus[eq]F")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderstatus" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_read_source_dispatch(spark, tmp_path):
    csv = tmp_path / "logs.tsv"
    csv.write_text("global_user_id\tloc_url\tlog_time\n1\thttp://a/product/1.html?x\t2019-08-01\n"
                   "2\thttp://b\t2019-08-02\n")
    got = meta.read_source(spark, {"inType": "HDFS", "inPath": str(csv), "sperator": "\t",
                                   "selectFieldNames": "global_user_id,loc_url"})
    assert got.columns == ["global_user_id", "loc_url"] and got.count() == 2
    assert dict(got.dtypes)["global_user_id"] == "int"
    spark.createDataFrame([(1, "2019-08-01"), (2, "2020-01-01")], "id long, log_time string") \
        .createOrReplaceTempView("k_logs")
    hive = meta.read_source(spark, {"inType": "hive", "hiveTable": "k_logs", "selectFieldNames": "id",
                                    "whereCondition": "log_time#day#30"}, as_of="2019-08-15")
    assert rows(hive) == [(1,)]
    pq = meta.read_source(spark, {"inType": "parquet", "path": f"{SF}/nation.parquet",
                                  "selectFieldNames": "n_nationkey", "filterConditions": "n_nationkey[lt]3"})
    # conditions compare as strings, like the cells of a wide table
    assert rows(pq) == [(i,) for i in range(25) if str(i) < "3"]


def test_jdbc_read_write_embedded(spark):
    url = "jdbc:derby:memory:kestrel_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, 1), (2, 2)], "ID int, GENDER int")
    df.write.mode("overwrite").jdbc(url, "USERS", properties=props)
    df.write.mode("append").jdbc(url, "USERS", properties=props)
    assert meta.read_jdbc_table(spark, url, "USERS", props).count() == 4
    sub = meta.read_source(spark, {"inType": "mysql", "url": url, "driver": props["driver"],
                                   "sql": 'SELECT "ID" FROM USERS WHERE "GENDER" = 2'})
    assert rows(sub) == [(2,), (2,)]


def test_headerless_tsv_and_libsvm(spark, tmp_path):
    tsv = tmp_path / "iris.data"
    tsv.write_text("5.1,3.5,1.4,0.2,Iris-setosa\n7.0,3.2,4.7,1.4,Iris-versicolor\n")
    df = meta.read_delimited(spark, str(tsv), "sl double, sw double, pl double, pw double, cls string")
    assert rows(df, "sl", "cls") == [(5.1, "Iris-setosa"), (7.0, "Iris-versicolor")]
    svm = tmp_path / "k.txt"
    svm.write_text("0 1:5.1 2:3.5\n1 1:7.0 3:4.7\n")
    lib = spark.read.format("libsvm").option("numFeatures", 4).load(str(svm))
    assert [r.features.size for r in lib.collect()] == [4, 4]


def test_parse_delimited_lines_keeps_trailing_empties(spark):
    lines = spark.createDataFrame([("1\ta\t",), ("2\tb",), ("3\tc\tx\ty",), ("x\tq\tz",)], "value string")
    got = meta.parse_delimited_lines(lines, ["id", "f1", "f2"], "\t", types={"id": "int"})
    assert rows(got) == [(None, "q", "z"), (1, "a", "")]
    ws = spark.createDataFrame([(" 1.0  2.0 3.0",), ("1 2",)], "value string")
    got = meta.parse_delimited_lines(ws, ["a", "b", "c"], r"\s+", types={"a": "double", "b": "double",
                                                                      "c": "double"}, regex=True)
    assert rows(got) == [(1.0, 2.0, 3.0)]


def test_tables_reader(spark):
    t = Tables(spark, SF)
    assert t.region.count() == 5


def test_jdbc_append_with_capped_connections_and_cell_export(spark, tmp_path):
    from kestrel.sources import sinks
    url = "jdbc:derby:memory:kestrel_sink;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(0, 500, numPartitions=16).selectExpr("CAST(id AS INT) AS ID", "CAST(id % 7 AS INT) AS K")
    sinks.write_jdbc(df, url, "ORDERS_T", properties=props, mode="overwrite", max_connections=2)
    sinks.write_jdbc(df, url, "ORDERS_T", properties=props, max_connections=2)
    assert meta.read_jdbc_table(spark, url, "ORDERS_T", props).count() == 1000
    out = str(tmp_path / "cells")
    sinks.export_cells(spark.createDataFrame([(2, "b"), (1, "a")], "id long, name string"), "id", "d", out)
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [("1", "d", "id", "1"), ("1", "d", "name", "a"), ("2", "d", "id", "2"),
                           ("2", "d", "name", "b")]


def test_cells_round_trip_scan(spark, tmp_path):
    from kestrel.sources import sinks
    users = spark.createDataFrame([(1, "1", "2019-08-01"), (2, "2", "2019-10-01"), (3, None, "2019-07-01")],
                                  "id long, gender string, modified string")
    out = str(tmp_path / "tbl_users")
    sinks.export_cells(users, "id", "detail", out, include_key=False)
    got = meta.read_source(spark, {"inType": "cells", "inPath": out, "family": "detail",
                                   "selectFieldNames": "id,gender,modified", "rowKey": "id",
                                   "filterConditions": "modified[lt]2019-09-01"})
    assert got.columns == ["id", "gender", "modified"]
    assert rows(got) == [("1", "1", "2019-08-01"), ("3", None, "2019-07-01")]
    other = meta.cells_scan(spark, out, "nofamily", ["gender"])
    assert other.count() == 0


def test_duplicate_rule_keys_raise(spark):
    tags = spark.createDataFrame([(318, "g", "inType=hive\ninType=hdfs", 4, 1)], CATALOG)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
        meta.parse_rule(tags)


def test_rule_text_with_blank_lines_and_a_bad_line(spark):
    def tags(rule):
        return spark.createDataFrame([(1, "t", rule, 4, 0)], "id long, name string, rule string, level int, pid long")
    assert meta.parse_rule(tags("\n inType=hive \n\n hiveTable=a.b\n where=x=1\n")) == {
        "inType": "hive", "hiveTable": "a.b", "where": "x=1"}
    with pytest.raises(Exception, match="without '='"):
        meta.parse_rule(tags("inType=hive\nno equals sign"))


def test_cells_scan_filters_on_unselected_columns(spark, tmp_path):
    cells = [(k, "f", q, v) for k, row in {"a": {"x": "1", "y": "7", "d": "2020-01-09"},
                                           "b": {"x": "2", "y": "8", "d": "2019-01-01"}}.items() for q, v in row.items()]
    path = str(tmp_path / "cells")
    spark.createDataFrame(cells, "row_key string, family string, qualifier string, value string").write.parquet(path)
    assert [tuple(r) for r in meta.cells_scan(spark, path, "f", "x", "y[eq]8").collect()] == [("b", "2")]
    got = meta.cells_scan(spark, path, "f", "x", None, "d#day#5", as_of="2020-01-10").collect()
    assert [tuple(r) for r in got] == [("a", "1")]


def _tasks(spark, group, run):
    """Number of tasks that ``run`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    return sum(i.numTasks for i in infos if i is not None), out


def test_sampled_schema_reads_the_files_once(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for k in range(24):
        (folder / f"p{k}.csv").write_text("id,name,score\n" + "".join(f"{k * 1000 + i},n{i},{i / 4}\n" for i in range(1000)))
    path = str(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        few, df = _tasks(spark, "sampled", lambda: meta.read_delimited_sampled(spark, path, sample_lines=50))
        all_, plain = _tasks(spark, "inferred", lambda: meta.read_delimited_with_header(spark, path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert df.dtypes == plain.dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    assert few <= 6 < all_ and df.count() == 24_000 and rows(df.where("id < 3")) == rows(plain.where("id < 3"))


def test_a_line_that_does_not_fit_the_sample_is_noticed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n" + "".join(f"{i},x\n" for i in range(100)) + "late,y\n")
    path = str(tmp_path / "a.csv")
    with pytest.raises(Exception, match="late,y"):
        meta.read_delimited_sampled(spark, path, sample_lines=20).select("id").collect()
    assert meta.read_delimited_sampled(spark, path, sample_lines=20).select("name").count() == 101
    kept = meta.read_delimited_sampled(spark, path, sample_lines=20, on_misfit="keep")
    assert [tuple(r) for r in kept.where(F.col(meta.CORRUPT).isNotNull()).collect()] == [(None, "y", "late,y")]
    assert meta.read_delimited_sampled(spark, path, sample_lines=1000).dtypes == [("id", "string"), ("name", "string")]


def test_jdbc_splits_follow_the_rows(spark):
    url = "jdbc:derby:memory:kestrel_splits;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    # nine rows in ten lie in a hundredth of the range; one value is hot; some ids are null
    ids = [i % 100 for i in range(1800)] + [7] * 300 + list(range(0, 10_000, 50)) + [None] * 20
    df = spark.createDataFrame([(i,) for i in ids], "ID int")
    df.write.mode("overwrite").jdbc(url, "SKEWED", properties={"driver": driver})
    parts = meta.jdbc_splits(spark, url, "SELECT * FROM SKEWED", '"ID"', 4, driver=driver)
    assert 2 <= len(parts) <= 4
    got = meta.read_jdbc_split(spark, url, "SELECT * FROM SKEWED", '"ID"', 4, driver=driver)
    sizes = got.rdd.glom().map(len).collect()
    assert sum(sizes) == len(ids) and max(sizes) <= len(ids) / 4 + 400     # a part, and the hot value
    assert rows(got) == rows(df)
    ruled = meta.read_source(spark, {"inType": "jdbc", "url": url, "driver": driver, "sql": "SELECT * FROM SKEWED",
                                     "partitionColumn": '"ID"', "numPartitions": "3"})
    assert ruled.count() == len(ids) and ruled.rdd.getNumPartitions() <= 3
    df.limit(0).write.mode("overwrite").jdbc(url, "NOTHING", properties={"driver": driver})
    assert meta.read_jdbc_split(spark, url, "SELECT * FROM NOTHING", '"ID"', 4, driver=driver).count() == 0
