"""The best N of one side's factors for each row of the other, without all pairs.

Scores are inner products of short vectors.  Both sides are packed into blocks of rows of
similar length; a block pair is one matrix product.  By Cauchy-Schwarz no item of a block
scores more than the user's length times the longest of the block's items, so after each
user has met the block of the longest items, a user block goes on only to those blocks
that could still beat the N-th score of one of its users.  The results are those of all
pairs; only the order of equal scores is fixed (by id).

A task holds a block of users, a block of items and the products of ``STRIP`` users with
it.  The driver gets one block of items and two numbers for each other one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, LongType, StructField, StructType

from kestrel.session import ensure_checkpoint_dir

BLOCK = 4096      # rows in a block, at most
STRIP = 256       # users multiplied at a time


def blocks(factors: DataFrame, size: int = BLOCK) -> DataFrame:
    """``(id, features)`` rows as ``(block, longest, ids, data)``: rows of similar length
    together, ``data`` their vectors as float32 one after the other."""
    id_type = factors.schema["id"].dataType
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = factors.select("id", F.col("features").cast("array<float>").alias("features"), length.alias("length"))
    n = rows.count()
    ranged = rows.repartitionByRange(max(1, -(-n // size)), F.desc("length"), "id").sortWithinPartitions(
        F.desc("length"), "id")

    def pack(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for pdf in batches:
            for k in range(0, len(pdf), size):
                part = pdf.iloc[k:k + size]
                yield pd.DataFrame([(number, float(part["length"].max()), part["id"].tolist(),
                                     np.stack(part["features"].to_numpy()).astype(np.float32).tobytes())],
                                   columns=["block", "longest", "ids", "data"])
                number += 1

    schema = StructType([StructField("block", LongType()), StructField("longest", DoubleType()),
                         StructField("ids", ArrayType(id_type)), StructField("data", BinaryType())])
    return ranged.mapInPandas(pack, schema)


def _best(users: np.ndarray, ids: list, items: np.ndarray, n: int):
    """Scores and places of each user's best ``n`` items, equal scores by id."""
    k, by_id = min(n, len(ids)), np.empty(len(ids), dtype=np.int64)
    by_id[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
    for start in range(0, len(users), STRIP):
        scores = users[start:start + STRIP] @ items.T
        if k < scores.shape[1]:
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        else:
            kth = scores.min(axis=1)
        for row, least in zip(scores, kth):
            some = np.flatnonzero(row >= least)
            order = some[np.lexsort((by_id[some], -row[some]))][:k]
            yield row[order], order


def top_n(users: DataFrame, items: DataFrame, n: int, *, size: int = BLOCK) -> DataFrame:
    """``(id, recommendations)`` for each row of ``users``: the ``n`` rows of ``items`` of
    the highest inner product, as an array of structs ``(id, rating)``, best first.

    Both sides are ``(id, features)`` with unique ids; ids may be numbers or text.  A
    subset of users is just a smaller ``users``.
    """
    user_type, item_type = users.schema["id"].dataType, items.schema["id"].dataType
    ensure_checkpoint_dir(users.sparkSession)
    u, i = blocks(users, size).checkpoint(), blocks(items, size).checkpoint()
    heads = i.orderBy(F.desc("longest"), "block").select("block", "longest").collect()   # 1 row per `size` items
    struct = StructType([StructField("rating", FloatType()), StructField("id", item_type)])
    found = StructType([StructField("id", user_type), StructField("best", ArrayType(struct))])
    if not heads:
        return users.sparkSession.createDataFrame([], StructType([
            StructField("id", user_type), StructField("recommendations", ArrayType(StructType([struct["id"], struct["rating"]])))]))
    first = i.where(F.col("block") == heads[0]["block"]).first()
    rank = len(first["data"]) // 4 // len(first["ids"])
    first_ids, first_data = list(first["ids"]), bytes(first["data"])
    others = [(int(h["block"]), float(h["longest"])) for h in heads[1:]]

    def matrix(data):
        return np.frombuffer(data, np.float32).reshape(-1, rank)

    def meet_first(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                vectors = matrix(row.data)
                best, floor = [], np.full(len(vectors), -np.inf)
                for k, (scores, places) in enumerate(_best(vectors, first_ids, matrix(first_data), n)):
                    best.append([{"rating": float(s), "id": first_ids[p]} for s, p in zip(scores, places)])
                    if len(scores) == n:
                        floor[k] = scores[-1]
                reach = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                # a margin for the rounding of float products
                meets = [b for b, longest in others if (reach * longest * (1 + 1e-5) + 1e-30 >= floor).any()]
                yield pd.DataFrame([(row.block, list(row.ids), row.data, best, meets)],
                                   columns=["block", "ids", "data", "best", "meets"])

    met = u.mapInPandas(meet_first, StructType([
        StructField("block", LongType()), StructField("ids", ArrayType(user_type)), StructField("data", BinaryType()),
        StructField("best", ArrayType(ArrayType(struct))), StructField("meets", ArrayType(LongType()))])).checkpoint()
    own = met.select(F.explode(F.arrays_zip("ids", "best")).alias("r")).select(
        F.col("r.ids").alias("id"), F.col("r.best").alias("best"))

    def meet(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids = list(row.item_ids)
                best = [[{"rating": float(s), "id": ids[p]} for s, p in zip(scores, places)]
                        for scores, places in _best(matrix(row.data), ids, matrix(row.item_data), n)]
                yield pd.DataFrame({"id": list(row.ids), "best": best})

    asked = met.select("ids", "data", F.explode("meets").alias("item_block"))
    more = asked.join(i.select(F.col("block").alias("item_block"), F.col("ids").alias("item_ids"),
                               F.col("data").alias("item_data")), "item_block").mapInPandas(meet, found)
    merged = own.unionByName(more).groupBy("id").agg(F.flatten(F.collect_list("best")).alias("all"))
    ordered = F.array_sort("all", lambda a, b: F.when(a["rating"] > b["rating"], -1).when(a["rating"] < b["rating"], 1)
                           .when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0))
    return merged.select("id", F.transform(F.slice(ordered, 1, n), lambda r: F.struct(
        r["id"].alias("id"), r["rating"].alias("rating"))).alias("recommendations"))
