"""Business data described by a tag's rule text.

A business (level-4) tag carries ``key=value`` lines that say where its data
lives, e.g.::

    inType=hive
    hiveTable=shop.tbl_logs
    selectFieldNames=global_user_id,loc_url,log_time
    whereCondition=log_time#day#30

``parse_rule`` turns the rule of the one level-4 row into a dict (one row
reaches the driver), ``read_source`` dispatches on ``inType`` to a
``DataFrameReader``.  Every reader applies the column projection and the
filters lazily, so they reach the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kestrel.operators.match import BUSINESS_LEVEL
from kestrel.sources.conditions import conditions_predicate, parse_conditions, where_condition_predicate

IN_TYPES = ("hdfs", "csv", "hive", "table", "mysql", "jdbc", "hbase", "wide", "parquet", "cells")


def rule_to_map(rule: Column) -> Column:
    """Rule text -> ``map<string,string>``; lines trimmed, blank ones skipped, split on
    the first ``=``.  A line without ``=`` fails the job and is named."""
    lines = F.filter(F.split(rule, r"\r?\n"), lambda x: F.trim(x) != "")

    def entry(line: Column) -> Column:
        at = F.instr(line, "=")
        key = F.when(at > 0, F.trim(F.substring(line, F.lit(1), at - 1))).otherwise(
            F.raise_error(F.concat(F.lit("rule line without '=': "), line)))
        return F.struct(key.alias("key"), F.trim(F.substring(line, at + 1, F.length(line))).alias("value"))

    return F.map_from_entries(F.transform(lines, entry))


def parse_rule(tags: DataFrame) -> dict[str, str]:
    """The level-4 row's rule as a dict (exactly one level-4 row expected)."""
    rows = (tags.where(F.col("level") == BUSINESS_LEVEL)
            .select(rule_to_map(F.col("rule")).alias("m")).limit(2).collect())
    if len(rows) != 1:
        raise ValueError(f"expected one business tag (level {BUSINESS_LEVEL}), got {len(rows)}")
    return {k.strip(): _unescape(v.strip()) for k, v in (rows[0]["m"] or {}).items()}


def _unescape(v: str) -> str:
    # A separator written as an escaped tab survives the line trimming.
    return {"\\t": "\t", "\\n": "\n"}.get(v, v)


def _fields(rule: dict) -> list[str]:
    text = rule.get("selectFieldNames") or rule.get("selectFields") or ""
    return [f.strip() for f in text.split(",") if f.strip()]


def _project(df: DataFrame, fields: list[str], as_string: bool = False) -> DataFrame:
    if not fields:
        return df
    return df.select(*[(F.col(f).cast("string") if as_string else F.col(f)).alias(f)
                       for f in fields])


def _filter(df: DataFrame, preds) -> DataFrame:
    preds = [p for p in preds if p is not None]
    return df.where(reduce(lambda a, b: a & b, preds)) if preds else df


def read_source(spark: SparkSession, rule: dict, as_of=None) -> DataFrame:
    """Dispatch on ``rule['inType']`` (case-insensitive); unknown types raise."""
    in_type = (rule.get("inType") or "").strip().lower()
    fields = _fields(rule)
    where = rule.get("whereCondition")
    if in_type in ("hdfs", "csv"):
        # "sperator" is a fixed value: existing rules spell the key so.
        sep = rule.get("sperator") or rule.get("separator") or ","
        if rule.get("schema"):  # a DDL schema saves the pass that infers one
            df = spark.read.schema(rule["schema"]).option("sep", sep).option("header", True).csv(rule["inPath"])
        else:
            df = read_delimited_with_header(spark, rule["inPath"], sep)
        return _project(_filter(df, [where_condition_predicate(where, as_of, df)]), fields)
    if in_type in ("hive", "table"):
        df = spark.read.table(rule.get("hiveTable") or rule["table"])
        return _project(_filter(df, [where_condition_predicate(where, as_of, df)]), fields)
    if in_type == "parquet":
        df = spark.read.parquet(rule.get("inPath") or rule["path"])
        cond = conditions_predicate(rule.get("filterConditions"), missing_passes=False, df=df)
        return _project(_filter(df, [cond, where_condition_predicate(where, as_of, df)]), fields)
    if in_type in ("mysql", "jdbc"):
        # partitionColumn, lowerBound, upperBound and numPartitions make it parallel
        column = rule.get("partitionColumn")
        if column and rule.get("lowerBound") is None:   # bounds are found in the database
            df = read_jdbc_split(spark, rule["url"], rule["sql"], column, int(rule.get("numPartitions") or 8),
                                 driver=rule.get("driver"), user=rule.get("user"), password=rule.get("password"))
            return _project(_filter(df, [where_condition_predicate(where, as_of, df)]), fields)
        parts = {"partition_column": column, "lower": int(rule["lowerBound"]), "upper": int(rule["upperBound"]),
                 "num_partitions": int(rule["numPartitions"])} if column else {}
        df = read_jdbc_query(spark, rule["url"], rule["sql"], driver=rule.get("driver"),
                             user=rule.get("user"), password=rule.get("password"), **parts)
        return _project(_filter(df, [where_condition_predicate(where, as_of, df)]), fields)
    if in_type == "cells":
        return cells_scan(spark, rule.get("inPath") or rule["path"], rule.get("family"), fields,
                          rule.get("filterConditions"), rule.get("whereCondition"), as_of,
                          key=rule.get("rowKey") or "row_key")
    if in_type in ("hbase", "wide"):
        return wide_scan(spark, rule.get("hbaseTable") or rule.get("table") or rule["path"],
                         fields, rule.get("filterConditions"), rule.get("whereCondition"), as_of)
    raise ValueError(f"unknown inType {rule.get('inType')!r}; expected one of {IN_TYPES}")


def read_delimited_with_header(spark: SparkSession, path: str, sep: str = ",",
                               infer: bool = True) -> DataFrame:
    """Header CSV/TSV; types inferred (one extra pass) unless ``infer=False``."""
    return (spark.read.option("sep", sep).option("header", True)
            .option("inferSchema", infer).csv(path))


CORRUPT = "__corrupt_line"


def sampled_schema(spark: SparkSession, path: str, sep: str = ",", sample_lines: int = 10_000) -> StructType:
    """Column names from the header and types from the first lines of the files: a scan that
    stops after ``sample_lines`` lines, instead of one over all of them."""
    lines = [r[0] for r in spark.read.text(path).limit(sample_lines).collect()]
    sample = (spark.read.option("sep", sep).option("header", True).option("inferSchema", True)
              .csv(spark.sparkContext.parallelize(lines, 1)))
    return sample.schema


def read_delimited_sampled(spark: SparkSession, path: str, sep: str = ",", sample_lines: int = 10_000,
                           on_misfit: str = "error") -> DataFrame:
    """Header CSV/TSV in one full pass, its types taken from the first lines.

    A later line that does not fit them, in a column that is read, is noticed in that same
    pass by the reader's column of corrupt lines: it fails the job (``error``), naming the
    line, or stays with nulls and its text in ``__corrupt_line`` (``keep``).
    """
    if on_misfit not in ("error", "keep"):
        raise ValueError("on_misfit must be 'error' or 'keep'")
    schema = sampled_schema(spark, path, sep, sample_lines)
    df = (spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
          .option("sep", sep).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    if on_misfit == "keep":
        return df
    bad = F.col(CORRUPT).isNotNull()
    # On every column, so that each projection checks the columns it reads.
    message = F.concat(F.lit("line does not fit the sampled types: "), F.col(CORRUPT))
    return df.select(*[F.when(bad, F.raise_error(message)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
                       for f in schema.fields])


def read_delimited(spark: SparkSession, path: str, schema: StructType | str,
                   sep: str = ",") -> DataFrame:
    """Headerless CSV/TSV with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def read_jdbc_query(spark: SparkSession, url: str, sql: str, *, driver: str | None = None,
                    user: str | None = None, password: str | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A sub-query scan, ``( sql ) AS tmp``; parallel when a partition column is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"( {sql} ) tmp")
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v:
            r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def jdbc_splits(spark: SparkSession, url: str, sql: str, column: str, partitions: int, *,
                probes: int | None = None, **connection) -> list[str]:
    """Predicates that cut a sub-query into parts of about equal numbers of rows.

    The database counts the rows in even cells between the column's least and greatest
    value, in one query; cells that hold too much are cut finer, again in one query a round,
    until none holds more than half a part or is one value.  Neighbouring cells then make
    the parts, so a hot range is cut where its rows are.  The last part takes nulls too.
    The driver gets the cells' counts only.
    """
    probes = probes or 4 * partitions

    def ask(query: str) -> list:
        return read_jdbc_query(spark, url, query, **connection).collect()

    low, high, n = ask(f"SELECT MIN({column}) AS LO, MAX({column}) AS HI, COUNT(*) AS N FROM ( {sql} ) t")[0]
    if low is None or partitions < 2:
        return ["1 = 1"]
    low, high = int(low), int(high)
    limit, cells, rough = max(1, n // (2 * partitions)), [], [(low, high + 1)]
    while rough:
        asked, rough = rough, []
        tests = []
        for a, b in asked:
            step = max(1, -(-(b - a) // max(2, probes // len(asked))))
            tests += [(c, min(c + step, b)) for c in range(a, b, step)]
        counts = ask("SELECT " + ", ".join(
            f"COUNT(CASE WHEN {column} >= {a} AND {column} < {b} THEN 1 END) AS C{k}"
            for k, (a, b) in enumerate(tests)) + f" FROM ( {sql} ) t")[0]
        for (a, b), held in zip(tests, counts):
            if held > limit and b - a > 1:
                rough.append((a, b))
            elif held:
                cells.append((a, b, int(held)))
    cells.sort()
    edges, held = [], 0
    for a, _, size in cells:
        if held and held + size > n / partitions and len(edges) < partitions - 1:
            edges.append(a)
            held = 0
        held += size
    bounds = [None, *edges, None]
    parts = [" AND ".join(p for p in (f"{column} >= {a}" if a is not None else "",
                                      f"{column} < {b}" if b is not None else "") if p) or "1 = 1"
             for a, b in zip(bounds, bounds[1:])]
    if edges:
        parts[-1] = f"{parts[-1]} OR {column} IS NULL"
    return parts


def read_jdbc_split(spark: SparkSession, url: str, sql: str, column: str, partitions: int, **connection) -> DataFrame:
    """A sub-query scan in parallel parts of about equal size (see :func:`jdbc_splits`)."""
    parts = jdbc_splits(spark, url, sql, column, partitions, **connection)
    props = {k: v for k, v in connection.items() if v and k in ("driver", "user", "password")}
    return spark.read.jdbc(url, f"( {sql} ) tmp", predicates=parts, properties=props)


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    **partitioning) -> DataFrame:
    props = dict(properties or {})
    if partitioning:
        return spark.read.jdbc(url, table, properties=props, **partitioning)
    return spark.read.jdbc(url, table, properties=props)


def wide_scan(spark: SparkSession, table_or_path: str, select_fields=None,
              filter_conditions: str | None = None, where_condition: str | None = None,
              as_of=None, missing_passes: bool = True) -> DataFrame:
    """Scan of a wide table; every selected column comes back as a string.

    ``filter_conditions`` (``f[op]v,...``) are compared as strings; a row
    whose field is null passes them unless ``missing_passes=False``.
    """
    if "/" in table_or_path:
        df = spark.read.parquet(table_or_path)
    else:
        df = spark.read.table(table_or_path)
    if isinstance(select_fields, str):
        select_fields = [f.strip() for f in select_fields.split(",") if f.strip()]
    fields = list(select_fields or df.columns)
    preds = [conditions_predicate(filter_conditions, missing_passes, df),
             where_condition_predicate(where_condition, as_of, df)]
    return _project(_filter(df, preds), fields, as_string=True)


def cells_scan(spark: SparkSession, path: str, family: str | None, select_fields,
               filter_conditions: str | None = None, where_condition: str | None = None,
               as_of=None, key: str = "row_key", missing_passes: bool = True) -> DataFrame:
    """Scan of key-value cells ``(row_key, family, qualifier, value)`` as a
    wide, all-string table: the family and the selected qualifiers are
    filtered in the scan, then one shuffle pivots the cells back into rows
    (``key`` names the row-key column; a selected field of that name is the
    row key itself).  Conditions apply as in :func:`wide_scan`.
    """
    if isinstance(select_fields, str):
        select_fields = [f.strip() for f in select_fields.split(",") if f.strip()]
    fields = [f for f in (select_fields or []) if f != key]
    if not fields:
        raise ValueError("cells_scan needs the qualifiers to read (selectFieldNames)")
    cells = spark.read.parquet(path)
    if family:
        cells = cells.where(F.col("family") == family)
    # Conditions may name qualifiers that are not selected: read them, filter, then project.
    tested = [c.field for c in parse_conditions(filter_conditions)]
    if where_condition and where_condition.strip():
        tested.append(where_condition.split("#")[0].strip())
    needed = fields + [f for f in dict.fromkeys(tested) if f not in fields and f != key]
    cells = cells.where(F.col("qualifier").isin(*needed))
    wide = (cells.groupBy(F.col("row_key").alias(key)).pivot("qualifier", needed)
            .agg(F.first("value")))
    preds = [conditions_predicate(filter_conditions, missing_passes),
             where_condition_predicate(where_condition, as_of, wide)]
    return _filter(wide, preds).select(key, *fields)


def parse_delimited_lines(lines: DataFrame, names: list[str], sep: str = "\t",
                          types: dict | None = None, value: str = "value",
                          regex: bool = False) -> DataFrame:
    """Text lines -> typed columns; lines with another token count are dropped.

    Trailing empty fields are kept (split limit -1), so a line ending in
    separators still has its full width.  ``sep`` is literal unless
    ``regex=True`` (e.g. ``r"\\s+"`` for whitespace).
    """
    import re as _re
    pattern = sep if regex else _re.escape(sep)
    src = F.trim(F.col(value)) if regex else F.col(value)
    toks = lines.select(F.split(src, pattern, -1).alias("__t"))
    types = types or {}
    return (toks.where(F.size("__t") == len(names))
            .select(*[(F.col("__t")[i].try_cast(types[n]) if n in types else F.col("__t")[i]).alias(n)
                      for i, n in enumerate(names)]))
