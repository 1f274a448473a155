"""Tag catalog operations on a DataFrame of ``(id, name, rule, level, pid)``.

The catalog is a 5-level tree: level 1 has ``pid = -1``; a level-4 row is a
business tag whose rule locates its data, its level-5 children are the
attribute tags.  Catalogs are small (thousands of rows), but nothing here
collects them: every operation is a DataFrame plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.broadcast import checked_broadcast
from kestrel.session import ensure_checkpoint_dir
from kestrel.sources.files import Files

ROOT_PID = -1
LEVELS = 5
TAG_COLUMNS = ("id", "name", "rule", "level")


def fetch_tag(tags: DataFrame, tag_id: int) -> DataFrame:
    """One business tag and its attribute children: ``id = x UNION pid = x``,
    ordered by (level, id)."""
    cols = [F.col(c) for c in TAG_COLUMNS]
    a = tags.where(F.col("id") == tag_id).select(*cols)
    b = tags.where(F.col("pid") == tag_id).select(*cols)
    return a.union(b).distinct().orderBy("level", "id")


def children(tags: DataFrame, parent_id: int) -> DataFrame:
    return tags.where(F.col("pid") == parent_id)


def at_level(tags: DataFrame, level: int) -> DataFrame:
    return tags.where(F.col("level") == level)


def paths(tags: DataFrame, level: int | None = LEVELS, sep: str = "/") -> DataFrame:
    """``(id, path)`` for every tag at ``level`` (None: for all): names from the root down.

    Works for any depth by pointer doubling: each round joins every tag's known stretch of
    ancestors with that of the stretch's end, so d levels take about log2(d) rounds.  A tag
    whose parent is not in the catalog is a root.  A cycle fails, naming one of its tags.
    """
    ensure_checkpoint_dir(tags.sparkSession)
    known = tags.select(F.col("id").alias("__known")).distinct()
    cur = (tags.select("id", "level", "name", F.col("pid").alias("__up"))
           .join(checked_broadcast(known), F.col("__up") == F.col("__known"), "left")
           .select("id", "level", F.array("name").alias("__names"), F.col("__known").alias("__up"))).checkpoint()
    rounds = max(1, cur.count()).bit_length() + 1   # beyond it, a stretch would be longer than the catalog
    for _ in range(rounds):
        if cur.where(F.col("__up").isNotNull()).limit(1).count() == 0:
            break
        # The catalog is thousands of rows; where it is not, the join stays a shuffle join.
        up = checked_broadcast(cur.select(F.col("id").alias("__end"), F.col("__names").alias("__above"),
                                          F.col("__up").alias("__next")))
        cur = (cur.join(up, F.col("__up") == F.col("__end"), "left")
               .select("id", "level", F.when(F.col("__end").isNull(), F.col("__names"))
                       .otherwise(F.concat("__above", "__names")).alias("__names"), F.col("__next").alias("__up"))
               ).checkpoint()
    else:
        stuck = cur.where(F.col("__up").isNotNull()).agg(F.min("id")).first()[0]
        if stuck is not None:
            raise ValueError(f"the ancestors of tag {stuck} run in a cycle")
    out = cur if level is None else cur.where(F.col("level") == level)
    return out.select("id", F.array_join("__names", sep).alias("path"))


def with_models(tags: DataFrame, models: DataFrame, parent_id: int | None = None) -> DataFrame:
    """Tags (optionally under one parent) left-joined to their model rows."""
    t = tags if parent_id is None else tags.where(F.col("pid") == parent_id)
    m = models.withColumnRenamed("id", "model_id")
    return t.join(m, t["id"] == m["tag_id"], "left").drop("tag_id")


def merge_chains(catalog: DataFrame | None, chains: DataFrame, names: list[str]) -> DataFrame:
    """Get-or-create tag chains; returns the grown catalog ``(id, name, level, pid)``.

    ``chains`` holds one chain per row, its level-1..n names in ``names``.
    Level by level, a node matches an existing tag on (name, level, pid); the
    missing ones get new ids after the current maximum, numbered in
    (pid, name) order, and become the parents of the next level.
    """
    spark = chains.sparkSession
    if catalog is None:
        catalog = spark.createDataFrame([], "id long, name string, level int, pid long")
    cat = catalog.select(F.col("id").cast("long"), "name", F.col("level").cast("int"),
                         F.col("pid").cast("long"))
    # Current chain ends: start at the root pid.
    # Every level reads the chains, the catalog and the new tags several times: each is
    # computed once, into the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    cat = cat.checkpoint()
    cur = chains.select(*[F.col(n) for n in names]).distinct().withColumn(
        "__pid", F.lit(ROOT_PID).cast("long")).checkpoint()
    for lvl, n in enumerate(names, start=1):
        nodes = cur.select(F.col(n).alias("name"), F.col("__pid").alias("pid")).distinct()
        existing = cat.where(F.col("level") == lvl).select(F.col("id"), "name", "pid")
        known = nodes.join(existing, ["name", "pid"], "left")
        # One scalar per level.  New ids follow (pid, name) order: numbered
        # within each parent, shifted by the new tags of the parents before
        # it (a window over one row per parent, never over all new tags).
        max_id = cat.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        fresh = known.where(F.col("id").isNull()).select("name", "pid")
        offsets = (fresh.groupBy("pid").agg(F.count(F.lit(1)).alias("__n"))
                   .withColumn("__off", F.sum("__n").over(Window.orderBy("pid")) - F.col("__n")))
        new = (fresh.join(offsets, "pid")
               .withColumn("id", F.lit(max_id) + F.col("__off")
                           + F.row_number().over(Window.partitionBy("pid").orderBy("name")))
               .select("id", "name", F.lit(lvl).alias("level"), "pid")).checkpoint()
        cat = cat.unionByName(new)
        ids = cat.where(F.col("level") == lvl).select(F.col("id").alias("__nid"), F.col("name").alias(n),
                                                      F.col("pid").alias("__pid"))
        cur = cur.join(ids, [n, "__pid"]).drop("__pid").withColumnRenamed("__nid", "__pid").checkpoint()
    return cat


class CatalogStore:
    """The catalog as parquet versions ``<root>/v=<n>``, grown by merging chains.

    A merge is computed against the newest version and renamed to the next number once
    written; if another job has taken that number meanwhile, its tags are in the new base,
    so the merge finds them and numbers only what is still missing.  So concurrent merges
    never give two tags one id, or one tag two.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def version(self) -> int:
        return max((int(n[2:]) for n in self.files.names() if n.startswith("v=") and n[2:].isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.version() if version is None else version
        return self.spark.read.parquet(f"{self.root}/v={v}") if v else None

    def merge(self, chains: DataFrame, names: list[str]) -> int:
        """Get or create the chains' tags; returns the version that has them all."""
        self.files.make("")
        while True:
            base = self.version()
            old, draft = self.read(base), f"_draft-{uuid.uuid4().hex}"
            grown = merge_chains(old, chains, names)
            try:
                grown.coalesce(1).write.parquet(f"{self.root}/{draft}")
                if old is not None and self.spark.read.parquet(f"{self.root}/{draft}").count() == old.count():
                    return base                       # nothing was missing
                if self.files.move_new(draft, f"v={base + 1}"):
                    return base + 1
            finally:
                if self.files.exists(draft):
                    self.files.delete(draft)
