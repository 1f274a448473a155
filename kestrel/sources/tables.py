"""Readers for the parquet tables the jobs run on.

Every reader returns a lazy DataFrame; projection and filters written after
it reach the parquet scan (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one table: ``<base>/<name>.parquet`` (file or directory)."""
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))


class Tables:
    """Attribute access to the tables under one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.base, name)

    def register_views(self, names=TABLES) -> None:
        for n in names:
            path = os.path.join(self.base, f"{n}.parquet")
            if os.path.exists(path):
                table(self.spark, self.base, n).createOrReplaceTempView(n)
