"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 64-bit key made of their text and id.  Splitters between
shards are found without sorting: each pass counts, exactly and in every
partition, the bytes and rows below a set of candidate boundaries, and the next
pass probes only the intervals that still hold a splitter, until the bytes below
every splitter are within tolerance.  Then the rows are exchanged once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kestrel.llm.common import whole, written

ROW_BYTES = 16
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def row_size(text: Column) -> Column:
    return F.octet_length(whole(text)).cast("long") + ROW_BYTES


def sort_key(text: Column, doc_id: Column) -> Column:
    """40 bits of the text's hash, then 24 of the id's: equal texts are neighbours,
    and a group of copies larger than a shard can still be cut."""
    high = F.shiftleft(F.shiftright(F.xxhash64(whole(text)), 24), 24)
    return high.bitwiseOR(F.xxhash64(doc_id).bitwiseAND(F.lit((1 << 24) - 1).cast("long")))


def below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the ascending ``probes``.

    ``keys`` has columns key, size.  A task sends at most one row per probe, and
    the driver gets at most one row per probe.
    """
    def count(batches):
        n_bytes = np.zeros(len(probes) + 1, dtype=np.int64)
        n_rows = np.zeros(len(probes) + 1, dtype=np.int64)
        for pdf in batches:
            at = np.searchsorted(probes, pdf["key"].to_numpy(), side="right")
            n_bytes += np.bincount(at, weights=pdf["size"], minlength=len(n_bytes)).astype(np.int64)
            n_rows += np.bincount(at, minlength=len(n_rows))
        at = np.flatnonzero(n_rows)
        yield pd.DataFrame({"at": at, "bytes": n_bytes[at], "rows": n_rows[at]})

    got = (keys.mapInPandas(count, "at long, bytes long, rows long")
           .groupBy("at").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect())
    n_bytes, n_rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in got:
        n_bytes[r["at"]], n_rows[r["at"]] = r["bytes"], r["rows"]
    return np.cumsum(n_bytes)[:-1], np.cumsum(n_rows)[:-1]


def splitters(keys: DataFrame, parts: int, total: int, tolerance: float,
              probes_each: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """``parts - 1`` ascending keys and the rows below each.

    A splitter is final when the bytes below it are within ``tolerance`` of a
    part's mean size from its exact place, or when its interval has no key left
    to probe (one key heavier than that): then the nearer end is taken.
    """
    targets = [total * i // parts for i in range(1, parts)]
    slack = tolerance * total / parts
    lo, hi = [LOW] * len(targets), [HIGH] * len(targets)
    best = [(abs(t), LOW, 0) for t in targets]  # distance, key, rows below
    while True:
        todo = [i for i in range(len(targets)) if best[i][0] > slack and hi[i] - lo[i] > 1]
        spans = {(lo[i], hi[i]) for i in todo}
        probes = sorted({a + (b - a) * j // (probes_each + 1) for a, b in spans
                         for j in range(1, probes_each + 1)} - {LOW})
        if not probes:
            break
        n_bytes, n_rows = below(keys, np.array(probes, dtype=np.int64))
        for i in todo:
            at = int(np.searchsorted(n_bytes, targets[i], side="left"))
            for j in (at - 1, at):
                if 0 <= j < len(probes):
                    off = abs(int(n_bytes[j]) - targets[i])
                    best[i] = min(best[i], (off, probes[j], int(n_rows[j])))
            if at > 0:
                lo[i] = max(lo[i], probes[at - 1])
            if at < len(probes):
                hi[i] = min(hi[i], probes[at])
    final = sorted((k, r) for _, k, r in best)
    return np.array([k for k, _ in final], np.int64), np.array([r for _, r in final], np.int64)


def shard_by_bytes(df: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id",
                   tolerance: float = 0.001, part_bytes: int = 256 << 20) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (int) and ``slot`` (long).

    Shards are key ranges whose bytes differ from the mean by little more than
    ``tolerance`` or one row.  A shard larger than ``part_bytes`` is exchanged
    as several ranges, so no task sorts a whole shard; the rows below each
    boundary, known from the last histogram, turn places in a range into
    ``slot``, gapless from 0 in the shard.

    A null text counts as empty; a null id is a value like any other; rows equal
    in text and id share a key and stay together; an empty table stays empty;
    columns named like the working ones (``__key`` ...) must not exist.
    """
    keyed = df.withColumns({"__key": sort_key(F.col(text), F.col(doc_id)),
                            "__size": row_size(F.col(text))})
    keys = written(keyed.select(F.col("__key").alias("key"), F.col("__size").alias("size")), "shard-keys")
    total = keys.agg(F.sum("size").alias("n")).first()["n"] or 0
    per_shard = max(1, -(-total // (shards * part_bytes)))
    cuts, rows_below = splitters(keys, shards * per_shard, total, tolerance)
    before = np.concatenate([[0], rows_below])
    in_shard = before - before[np.arange(len(before)) // per_shard * per_shard]

    @F.pandas_udf("part int, first long")
    def place(key: pd.Series) -> pd.DataFrame:
        part = np.searchsorted(cuts, key.to_numpy(), side="right")
        return pd.DataFrame({"part": part.astype(np.int32), "first": in_shard[part]})

    order = W.partitionBy("__part").orderBy("__key", doc_id)
    return (keyed.withColumn("__place", place("__key"))
            .withColumns({"__part": F.col("__place.part"), "__first": F.col("__place.first")})
            .withColumns({"shard": F.floor(F.col("__part") / per_shard).cast("int"),
                          "slot": F.row_number().over(order).cast("long") - 1 + F.col("__first")})
            .drop("__key", "__size", "__place", "__part", "__first"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write every row of ``df`` under ``path/shard=N``, ordered by slot."""
    out = shard_by_bytes(df, **options)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text", row_size(F.col("text")).alias("size"),
                         F.crc32(whole(F.col("text")).cast("binary")).alias("text_crc32"))
    return shard_by_bytes(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
