"""Writers: JDBC append and the key-value cell export."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.profile import to_cells


def write_jdbc(df: DataFrame, url: str, table: str, *, properties: dict | None = None,
               mode: str = "append", max_connections: int = 8, batch_size: int = 1000) -> None:
    """Append (or overwrite) rows into a database table.

    At most ``max_connections`` tasks write at once (``numPartitions`` makes
    Spark coalesce before writing), so a large cluster does not open one
    connection per task against a single database; rows go in batches.
    """
    props = dict(properties or {})
    (df.write.mode(mode).option("numPartitions", max_connections)
     .option("batchsize", batch_size).jdbc(url, table, properties=props))


def export_cells(df: DataFrame, key: str, family: str, path: str, *,
                 include_key: bool = True) -> None:
    """Write the wide rows as ``(row_key, family, qualifier, value)`` files,
    globally ordered by row key and qualifier across the part files."""
    to_cells(df, key, family, include_key=include_key).write.mode("overwrite").parquet(path)


def export_split_cells(df: DataFrame, key: str, family: str, path: str, splits: list[str], *,
                       include_key: bool = True) -> DataFrame:
    """Write the cells so that no file crosses a split; returns the manifest.

    ``splits`` are the row keys at which a store's regions begin (the first region begins
    with the first key).  Files lie in one folder a region, ordered by row key and
    qualifier within a file and from file to file; a large region has several.  The
    manifest, ``(region, file, first_key, last_key, n_cells)``, is written beside them
    (``<path>/_manifest``) for a loader that takes the files region by region.
    """
    cells = to_cells(df, key, family, include_key=include_key, sort=False)
    bounds = F.from_json(F.lit(json.dumps(sorted(set(splits)))), "array<string>")
    placed = cells.withColumn("region", F.size(F.filter(bounds, lambda b: b <= F.col("row_key"))))
    order = ["region", "row_key", "qualifier", "value"]
    (placed.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("region").parquet(path))
    # Reads back one column of the files just written.
    manifest = (df.sparkSession.read.parquet(path).groupBy("region", F.input_file_name().alias("file"))
                .agg(F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"),
                     F.count(F.lit(1)).alias("n_cells")))
    manifest.write.mode("overwrite").parquet(f"{path}/_manifest")
    return df.sparkSession.read.schema(manifest.schema).parquet(f"{path}/_manifest")
