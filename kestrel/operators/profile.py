"""The per-user profile table and its key-value export forms.

* ``upsert`` merges freshly computed tag columns into the wide profile:
  cell-level, keyed by ``userId``; other users and other columns stay, a
  null new value never overwrites an old one.  One full outer join on the
  key; with the stored profile bucketed by ``userId`` only the new side is
  shuffled.
* ``ProfileStore`` keeps the profile as parquet versions under one folder; a
  version counts once its write committed (readers never see a half written
  table, a failed job leaves the last version current); ``BucketStore`` in
  ``bucket_store.py`` rewrites only the buckets that a save touches.
* ``to_cells`` / ``tags_string_to_cells`` give the long
  ``(row_key, family, qualifier, value)`` form, sorted for export.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.files import Files

KEY = "userId"
_CLAIMS = threading.Lock()


def upsert(profile: DataFrame | None, new: DataFrame, key: str = KEY) -> DataFrame:
    """Profile with ``new``'s columns merged in (see module doc).

    Rows of ``new`` without a key are left out, and several rows of one key count
    as one that has, in each column, the greatest of their values; so saving the
    same rows again changes nothing.
    """
    new_cols = [c for c in new.columns if c != key]
    new = (new.where(F.col(key).isNotNull()).groupBy(key)
           .agg(*[F.max(c).alias(c) for c in new_cols]) if new_cols
           else new.where(F.col(key).isNotNull()).select(key).distinct())
    if profile is None:
        return new
    old_cols = [c for c in profile.columns if c != key]
    p = profile.alias("p")
    n = new.alias("n")
    j = p.join(n, F.col(f"p.{key}") == F.col(f"n.{key}"), "full_outer")
    out = [F.coalesce(F.col(f"n.{key}"), F.col(f"p.{key}")).alias(key)]
    for c in old_cols:
        if c in new_cols:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"p.{c}")).alias(c))
        else:
            out.append(F.col(f"p.{c}").alias(c))
    out += [F.col(f"n.{c}").alias(c) for c in new_cols if c not in old_cols]
    return j.select(*out)


class ProfileStore:
    """Versioned parquet profile under ``root``: ``v=1/``, ``v=2/``, ...

    The current version is the highest one whose ``_SUCCESS`` marker exists,
    so a job that dies mid-write leaves the previous version current.  Paths
    go through the Hadoop file system of the session, so ``root`` may be any
    shared store the cluster mounts (HDFS, object store, shared disk).
    """

    def __init__(self, spark: SparkSession, root: str, key: str = KEY, buckets: int | None = None,
                 stale_s: float = 3600):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.stale_s = stale_s

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        jvm, fs = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("v=") and name[2:].isdigit() and fs.exists(
                    jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self) -> DataFrame | None:
        v = self.current_version()
        return None if v is None else self.spark.read.parquet(f"{self.root}/v={v}")

    def save(self, new: DataFrame) -> int:
        """Upsert ``new`` into the current version and write the next version.

        The version is written aside and renamed to its number once complete, which fails
        if another job has taken that number: then it is merged once more, onto that job's
        version.  So no save loses a tag, however long it takes.  A claim on the next
        number keeps jobs from doing so in vain; that of a job that seems dead is passed
        over after ``stale_s`` seconds.
        """
        files = Files(self.spark, self.root)
        files.make("")
        while True:
            base = self._wait_turn(files)
            v = base + 1
            draft = f"_draft-{uuid.uuid4().hex}"
            old = self.spark.read.parquet(f"{self.root}/v={base}") if base else None
            merged = upsert(old, new, self.key)
            w = merged.repartition(self.buckets, self.key) if self.buckets else merged
            try:
                w.write.parquet(f"{self.root}/{draft}")
                if files.exists(f"v={v}") and not files.exists(f"v={v}/_SUCCESS"):
                    files.delete(f"v={v}")          # left by a job that wrote in place and died
                if files.move_new(draft, f"v={v}"):
                    return v
            except BaseException:
                files.delete(f"_claim-{v}")
                raise
            finally:
                if files.exists(draft):
                    files.delete(draft)

    def _wait_turn(self, files: Files) -> int:
        """The version to merge onto (0: none), once no living job claims the next one."""
        while True:
            base = self.current_version() or 0
            claim = f"_claim-{base + 1}"
            with _CLAIMS:  # HDFS creates a file once; a local disk needs this among threads
                mine = files.fs.createNewFile(files.path(claim))
            if mine or files.age_s(claim) >= self.stale_s:
                if (self.current_version() or 0) == base:
                    return base
                if mine:
                    files.delete(claim)
            else:
                time.sleep(0.5)

    def prune(self, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` newest committed versions; returns those deleted.

        To be called when no reader still uses them.
        """
        jvm, fs = self._fs()
        old = self.versions()[:-keep] if keep > 0 else []
        for v in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={v}"), True)
        return old


class BucketedProfileTable:
    """Versioned profile as catalog tables ``<name>_v<n>``, bucketed and
    sorted by the key.

    Reading a version keeps its bucket layout, so the upsert's join with the
    new tags shuffles only the new side (hashed into the same buckets); the
    stored profile, the large side, is read in place.  A version exists once
    its ``saveAsTable`` committed.
    """

    def __init__(self, spark: SparkSession, name: str, key: str = KEY, buckets: int = 64):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets

    def versions(self) -> list[int]:
        prefix = f"{self.name}_v".lower()
        out = []
        for t in self.spark.catalog.listTables():
            n = t.name.lower()
            if not t.isTemporary and n.startswith(prefix) and n[len(prefix):].isdigit():
                out.append(int(n[len(prefix):]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self) -> DataFrame | None:
        v = self.current_version()
        return None if v is None else self.spark.table(f"{self.name}_v{v}")

    def save(self, new: DataFrame) -> int:
        base = self.current_version()
        old = None if base is None else self.spark.table(f"{self.name}_v{base}")
        # one task a bucket: else every task of the merge writes a file per bucket
        merged = upsert(old, new, self.key).repartition(self.buckets, self.key)
        v = (base or 0) + 1
        (merged.write.bucketBy(self.buckets, self.key).sortBy(self.key)
         .mode("error").saveAsTable(f"{self.name}_v{v}"))
        return v


class TagColumnStore:
    """The profile kept as one narrow table per tag column: ``<root>/<tag>/v=<n>``.

    Saving a tag job's result rewrites only that tag's ``(userId, value)``
    table (upserted into its previous version); the other tags are not
    touched, so the write grows with one column, not with the whole profile.
    ``read`` assembles the wide profile with one shuffle: the narrow tables
    are stacked as ``(userId, tag, value)`` cells and pivoted back.  Values
    are kept as strings, like the cells of a wide-column store; a user with
    no non-null tag value has no row.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = KEY):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def _column(self, tag: str) -> ProfileStore:
        return ProfileStore(self.spark, f"{self.root}/{tag}", self.key)

    def tags(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
        return sorted(n for n in names if self._column(n).current_version() is not None)

    def save(self, new: DataFrame) -> dict[str, int]:
        """Upsert every tag column of ``new`` into its own table."""
        new = new.persist(StorageLevel.MEMORY_AND_DISK)  # computed once for all columns
        try:
            return {c: self._column(c).save(new.select(F.col(self.key), F.col(c).cast("string").alias("value")))
                    for c in new.columns if c != self.key}
        finally:
            new.unpersist()

    def read(self, tags: list[str] | None = None) -> DataFrame | None:
        tags = sorted(tags or self.tags())
        if not tags:
            return None
        cells = None
        for t in tags:
            part = (self._column(t).read().where(F.col("value").isNotNull())
                    .select(F.col(self.key), F.lit(t).alias("tag"), "value"))
            cells = part if cells is None else cells.unionByName(part)
        return cells.groupBy(self.key).pivot("tag", tags).agg(F.first("value"))


def recommendations_to_strings(recs: DataFrame, *, user: str = "userId",
                               item: str = "productId", rating: str = "rating",
                               array: str = "recommendations") -> DataFrame:
    """ALS top-N ``array<struct>`` -> comma-joined ``productIds`` and ``ratings``."""
    return recs.select(
        F.col(user).alias(KEY),
        F.concat_ws(",", F.transform(F.col(array), lambda x: x[item].cast("string"))).alias("productIds"),
        F.concat_ws(",", F.transform(F.col(array), lambda x: x[rating].cast("string"))).alias("ratings"))


def sync_strings(df: DataFrame) -> DataFrame:
    """Table sync form: every column as string, names lower-cased, blanks -> null."""
    out = []
    for c in df.columns:
        s = F.col(f"`{c}`").cast("string")
        out.append(F.when(F.length(F.trim(s)) > 0, s).alias(c.lower()))
    return df.select(*out)


def sync_table(df: DataFrame, key: str, store: "ProfileStore | None" = None):
    """Table sync: string form (see ``sync_strings``) keyed by ``userId``;
    blanks are null, so the upsert never writes them.  With a ``store`` the
    rows are upserted and the new version number is returned."""
    s = sync_strings(df).withColumnRenamed(key.lower(), KEY)
    return store.save(s) if store is not None else s


def to_cells(df: DataFrame, key: str, family: str, include_key: bool = True,
             sort: bool = True, partitions: int | None = None) -> DataFrame:
    """Wide rows -> ``(row_key, family, qualifier, value)``, null or blank cells dropped.

    With ``sort`` the cells are range-partitioned on the row key and sorted by
    (row key, qualifier) inside each partition: a globally ordered export
    without a single-task sort.
    """
    value_cols = sorted(c for c in df.columns if include_key or c != key)
    s = sync_strings(df.select(F.col(key).alias("__k"), *[F.col(c) for c in value_cols]))
    lowered = [c.lower() for c in value_cols]
    long = (s.unpivot(["__k"], lowered, "qualifier", "value")
            .where(F.col("value").isNotNull())
            .select(F.col("__k").cast("string").alias("row_key"), F.lit(family).alias("family"),
                    "qualifier", "value"))
    if sort:
        # Range partitions on the full sort key: the global order is the same
        # as by row key, and a row key with very many cells is spread over
        # several tasks instead of one.  Without an explicit count AQE sizes
        # the partitions from the data.
        order = ["row_key", "qualifier", "value"]
        ranged = (long.repartitionByRange(int(partitions), *order) if partitions
                  else long.repartitionByRange(*order))
        long = ranged.sortWithinPartitions(*order)
    return long


def tags_string_to_cells(df: DataFrame, key: str, tags: str, item_sep: str = ",",
                         kv_sep: str = ":") -> DataFrame:
    """``"field:value,field:value"`` -> ``(userId, field, value)`` rows.

    Items split on their first ``kv_sep``; an item without one has a null
    value.  A field repeated within one string gives one row per item (no
    job failure, unlike a map with duplicate keys).
    """
    import re as _re
    items = F.explode(F.split(F.col(tags), _re.escape(item_sep)))
    kv = F.split(F.col("__item"), _re.escape(kv_sep), 2)
    return (df.select(F.col(key).alias(KEY), items.alias("__item"))
            .where(F.length(F.trim("__item")) > 0)
            .select(KEY, F.trim(kv[0]).alias("field"),
                    F.trim(F.get(kv, 1)).alias("value")))


def cells_to_wide(cells: DataFrame, fields: list[str], key: str = KEY) -> DataFrame:
    """Long ``(key, field, value)`` -> one column per field (values listed, so no extra pass)."""
    return cells.groupBy(key).pivot("field", fields).agg(F.first("value"))



def log_lines_to_cells(lines: DataFrame, names: list[str], key: str, family: str,
                       sep: str = "\t") -> DataFrame:
    """Log ingest: delimited lines of exactly ``len(names)`` fields -> cells.

    Wrong-width lines are dropped, trailing empty fields kept; the key field
    becomes the row key and is not stored as a cell.
    """
    from kestrel.sources.meta import parse_delimited_lines
    return to_cells(parse_delimited_lines(lines, names, sep), key, family, include_key=False)
