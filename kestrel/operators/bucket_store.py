"""The profile as copy-on-write hash buckets.

``<root>/data/<commit>/bucket=<b>/`` holds the rows of a bucket as one commit wrote them,
``<root>/manifests/<version>.json`` says for each bucket which commit's files are current.
A save reads and rewrites only the buckets that its users fall into, then adds a manifest
that shares all other buckets with the one before.

Nobody waits for a lock.  A save may take any time: it is prepared against the version it
read, and committed by renaming a finished manifest to the next version's name, which
fails if that exists.  The version number so fences a writer that others have passed: it
can't commit what it prepared, but takes their version as its base, merges once more those
of its buckets that they rewrote too, and tries again.  So concurrent and slow saves lose
no tag, and what a dead job leaves behind is never read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from kestrel.operators.profile import KEY, upsert
from kestrel.sources.files import Files

BUCKET = "__bucket"


@dataclass
class Manifest:
    version: int = 0
    buckets: int = 0
    schema: dict | None = None
    commits: dict = field(default_factory=dict)   # bucket -> commit whose files hold it

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        d = json.loads(text)
        return cls(d["version"], d["buckets"], d["schema"], {int(b): c for b, c in d["commits"].items()})


class BucketStore:
    """See the module's text.  ``buckets`` is fixed by the first save; a bucket is what one
    task merges and writes, so it should hold some hundred megabytes at most.

    ``replace=True`` makes a save replace all of a user's columns (a recommendation table)
    instead of only those that have a value.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = KEY, buckets: int = 64, replace: bool = False):
        self.spark, self.root, self.key, self.replace = spark, root.rstrip("/"), key, replace
        self.default_buckets = buckets
        self.files = Files(spark, self.root)

    # ------------------------------------------------------------- reading

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names("manifests") if n.endswith(".json") and n[:-5].isdigit())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def manifest(self, version: int | None = None) -> Manifest:
        v = self.current_version() if version is None else version
        if v is None:
            return Manifest(buckets=self.default_buckets)
        return Manifest.from_json(self.files.read_text(f"manifests/{v}.json"))

    def _read(self, m: Manifest, buckets=None) -> DataFrame | None:
        if m.schema is None:
            return None
        paths = [f"{self.root}/data/{c}/bucket={b}" for b, c in sorted(m.commits.items())
                 if buckets is None or b in buckets]
        schema = StructType.fromJson(m.schema)
        # columns that a bucket was written without are null there
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        return self._read(self.manifest(version))

    def lookup(self, keys: list) -> DataFrame | None:
        """The rows of some users: only their buckets are read."""
        m = self.manifest()
        if m.schema is None:
            return None
        kind = StructType.fromJson(m.schema)[self.key].dataType
        wanted = self.spark.createDataFrame([(k,) for k in keys], StructType().add(self.key, kind))
        buckets = {r[0] for r in wanted.select(self._bucket(m)).distinct().collect()}
        return self._read(m, buckets).where(F.col(self.key).isin(list(keys)))

    def _bucket(self, m: Manifest):
        # of the value's text: a key saved as int and as long is one user
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(m.buckets)).cast("int")

    # ------------------------------------------------------------- writing

    def prepare(self, new: DataFrame) -> "Pending":
        """Write what ``new`` changes, without committing it."""
        return Pending(self, new)

    def save(self, new: DataFrame) -> int:
        """Upsert ``new``; returns the committed version."""
        return self.prepare(new).commit()

    def vacuum(self, keep: int = 2, older_than_s: float = 7 * 86400) -> list[str]:
        """Delete all but the ``keep`` newest manifests, and the commits that none of those
        uses and that are older than any save takes; returns the commits deleted."""
        versions = self.versions()
        for v in versions[:-keep]:
            self.files.delete(f"manifests/{v}.json")
        used = {c.split("/")[0] for v in versions[-keep:] for c in self.manifest(v).commits.values()}
        gone = [c for c in self.files.names("data") if c not in used and self.files.age_s(f"data/{c}") > older_than_s]
        for c in gone:
            self.files.delete(f"data/{c}")
        return gone


class Pending:
    """A save that is written but not yet current."""

    def __init__(self, store: BucketStore, new: DataFrame):
        self.store, self.base = store, store.manifest()
        self.written: dict[int, str] = {}
        # The new rows are read once for the list of buckets and once per merge; a bucket a
        # row at most comes to the driver.
        self.commit_id = uuid.uuid4().hex
        rows = new.where(F.col(store.key).isNotNull())
        self.incoming = f"{store.root}/data/{self.commit_id}/incoming"
        rows.withColumn(BUCKET, store._bucket(self.base)).write.parquet(self.incoming)
        self.new = store.spark.read.schema(StructType([*rows.schema.fields, StructField(BUCKET, IntegerType())])).parquet(self.incoming)
        self.touched = sorted(r[0] for r in self.new.select(BUCKET).distinct().collect())
        self.schema = self._merge(self.touched)

    def _merge(self, buckets: list[int]) -> dict:
        """Merge the new rows into ``buckets`` of the base and write those; the new schema."""
        store = self.store
        old = store._read(self.base, set(buckets))
        new = self.new.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        merged = upsert(old, new, store.key)
        if store.replace and old is not None:
            kept = old.join(new.select(store.key).distinct(), store.key, "left_anti")
            merged = upsert(None, new, store.key).unionByName(kept, allowMissingColumns=True)
        if buckets:
            commit = f"{self.commit_id}/{uuid.uuid4().hex}"
            # one task a bucket, so one file a bucket
            (merged.withColumn("bucket", store._bucket(self.base)).repartition(len(buckets), "bucket")
             .write.partitionBy("bucket").parquet(f"{store.root}/data/{commit}"))
            self.written.update({b: commit for b in buckets})
        # the base's columns stay, whether or not the merge read any of their rows
        schema = StructType.fromJson(self.base.schema) if self.base.schema else StructType()
        for f in merged.schema.fields:
            if f.name not in schema.names:
                schema = schema.add(f.name, f.dataType, True)
        return json.loads(schema.json())

    def commit(self) -> int:
        store = self.store
        store.files.make("manifests")
        while True:
            m = Manifest(self.base.version + 1, self.base.buckets, self.schema,
                         {**self.base.commits, **self.written})
            draft = f"manifests/.{self.commit_id}"
            store.files.write_text(draft, m.to_json())
            if store.files.move_new(draft, f"manifests/{m.version}.json"):
                store.files.delete(f"data/{self.commit_id}/incoming")
                return m.version
            # Others have committed: their version is the new base, and what both wrote is merged again.
            theirs = store.manifest()
            if theirs.buckets != self.base.buckets:          # another first save chose another number
                self.base = theirs
                self.new = self.new.withColumn(BUCKET, store._bucket(theirs))
                self.touched = sorted(r[0] for r in self.new.select(BUCKET).distinct().collect())
                self.written, again = {}, self.touched
            else:
                again = [b for b in self.touched if theirs.commits.get(b) != self.base.commits.get(b)]
                self.base = theirs
            self.schema = self._merge(again)
